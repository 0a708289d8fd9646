"""SentencePiece encoding and decoding with N-best segmentations.

The piece lattice of a text is searched backward by A-star; the forward Viterbi scores are the exact best score from
the start to each place, so they are a perfect heuristic and each search step lies on a path that will be returned.
Where no piece of the vocabulary can cross (before a word mark, around characters that no longer piece holds) the
lattice falls into independent segments, which repeat a lot; a segment's Viterbi result is computed once per worker.

What scores mean depends on the file. Those of a unigram file are log probabilities, and the best segmentation is the
library's own. Those of a BPE file are merge ranks, of which a sum means nothing, and the library's own segmentation
follows the merges: there the first of the N best is the library's, and the others come from the lattice, in which a
piece of rank r has Zipf's log probability -log(r + 2).
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm._base import replacing

MARK = "▁"
UNKNOWN_PENALTY = 10.0
NEG = -1e300
_CACHE = 400_000  # segments that a worker remembers, about 100 MB
_WIDE = 24  # longest segment that takes the vectorised Viterbi
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


class PieceModel:
    """A SentencePiece vocabulary as a lattice: pieces with scores, and bytes (or the unknown piece) as a last resort."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte_ids: dict[int, int] = {}
        self.table: dict[str, tuple[int, float]] = {}
        self.out: list[bytes] = []
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                self.out.append(bytes([int(p[1:-1], 16)]))
            elif sp.is_control(i):
                self.out.append(b"")
            elif sp.is_unknown(i):
                self.out.append(" ⁇ ".encode())
            else:
                self.out.append(p.encode())
                if not sp.is_unused(i):
                    self.table[p] = (i, sp.get_score(i))
        self.merges = self._by_merges()
        if self.merges:
            self.table = {p: (i, -math.log(2 - min(w, 0.0))) for p, (i, w) in self.table.items()}
        self.unknown_score = min((s for _, s in self.table.values()), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.table), default=1)
        self.prefix = sp.normalize("x").startswith(MARK)
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.table)
        joined = sorted({c for p in self.table if len(p) > 1 for c in p} - {MARK})
        inside = "".join(map(re.escape, joined))
        # a segment: word marks with what follows them, a run without marks, or one character that never joins
        runs = f"{MARK}+[{inside}]*|[{inside}]+|[^{inside}{MARK}]" if joined else f"{MARK}+|[^{MARK}]"
        self.segments = re.compile("(?s).+" if crossing else f"(?s:{runs})").findall
        self._clear()
        self._spelt = None
        self._seen = np.zeros(1 << 20, bool)  # of a piece's hash the top 20 bits: most lookups end here
        self._hashes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in range(1, self.longest + 1):
            own = [(self._hash(p), *v) for p, v in self.table.items() if len(p) == n]
            own.sort()
            for h, _, _ in own:
                self._seen[h >> 44] = True
            self._hashes.append(tuple(np.array([x[k] for x in own], t) for k, t in ((0, np.uint64), (1, np.int64), (2, np.float64))))

    def _by_merges(self) -> bool:
        """Whether the file is one of merges: for those the library has no N-best search."""
        try:
            self.sp.nbest_encode_as_ids("a b", 2)
        except (RuntimeError, OSError, NotImplementedError):
            return True
        return False

    def own_ids(self, segments: list[str]) -> list[list[int]]:
        """The library's ids of segments. A line feed in front, which joins with nothing, keeps the word mark away that
        the library sets before a text; the ids of the mark and the line feed are cut off again."""
        lead = len(self.sp.encode("\n"))
        return [x[lead:] for x in self.sp.encode(["\n" + s.replace(MARK, " ") for s in segments], num_threads=1)]

    @staticmethod
    def _hash(p: str) -> int:
        h = 0
        for c in p:
            h = ((h + ord(c) + 1) * int(_P)) & 0xFFFFFFFFFFFFFFFF
            h ^= h >> 29
        return h

    def normalize(self, text: str) -> str:
        return self.sp.normalize(text) if text else ""

    def fallback(self, c: str) -> tuple[int, ...]:
        if self.byte_ids:
            return tuple(self.byte_ids[b] for b in c.encode())
        return (self.sp.unk_id(),)

    def into(self, s: str, j: int) -> list[tuple[int, tuple[int, ...], float]]:
        """(start, ids, score) of each piece that ends at place ``j``, found anew each time: a long segment without a
        word mark costs 8 bytes a character and no table of pieces."""
        out = []
        get = self.table.get
        for i in range(max(0, j - self.longest), j):
            hit = get(s[i:j])
            if hit:
                out.append((i, (hit[0],), hit[1]))
        if s[j - 1] not in self.table:
            out.append((j - 1, self.fallback(s[j - 1]), self.unknown_score))
        return out

    def nbest(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of a segment, best first; fewer if there are fewer. Backward A-star."""
        size = len(s)
        alpha = array("d", [NEG]) * (size + 1)
        alpha[0] = 0.0
        for j in range(1, size + 1):
            alpha[j] = max((alpha[i] + w for i, _, w in self.into(s, j)), default=NEG)
        # an entry: estimate of the whole path, place reached (nearer the start first, so ties finish), order, path
        heap: list[tuple] = [(-alpha[size], size, 0, 0.0, None)]
        pushed = 1
        seen: dict[int, int] = {}
        done: list[tuple[float, tuple[int, ...]]] = []
        while heap and len(done) < n:
            _, place, _, score, path = heapq.heappop(heap)
            if place == 0:
                ids: list[int] = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                done.append((score, tuple(ids)))
                continue
            seen[place] = seen.get(place, 0) + 1
            if seen[place] > n:  # n better ways from here to the end are already known
                continue
            for i, ids_, w in self.into(s, place):
                if alpha[i] > NEG:
                    heapq.heappush(heap, (-(alpha[i] + w + score), i, pushed, w + score, (ids_, path)))
                    pushed += 1
        return done

    def _vector(self, words: list[str]) -> None:
        """Forward and backward Viterbi over many short segments at once: best ids, best score, gap to the second.

        Arrays run along the segments, place by place, so each step is one pass over adjacent memory.
        """
        width = max(map(len, words))
        count = len(words)
        sizes = np.fromiter(map(len, words), np.int64, count)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        codes = np.zeros((count, width), np.uint64)
        codes[np.arange(width)[None, :] < sizes[:, None]] = flat
        codes = np.ascontiguousarray(codes.T)
        places = np.arange(width)[:, None]
        score, ident = [], []
        h = np.zeros((width, count), np.uint64)
        for n in range(1, min(self.longest, width) + 1):
            m = width - n + 1
            h = (h[:m] + codes[n - 1 :] + np.uint64(1)) * _P
            h ^= h >> np.uint64(29)
            keys, ids, w = self._hashes[n - 1]
            s = np.full((m, count), NEG)
            d = np.full((m, count), -1, np.int32)
            valid = places[:m] + n <= sizes[None, :]
            if len(keys):
                valid &= self._seen[h >> np.uint64(44)]
                looked = h[valid]
                at = np.minimum(np.searchsorted(keys, looked), len(keys) - 1)
                hit = keys[at] == looked
                s[valid] = np.where(hit, w[at], NEG)
                d[valid] = np.where(hit, ids[at], -1)
            if n == 1:
                s[(places[:m] + n <= sizes[None, :]) & (d < 0)] = self.unknown_score
            score.append(s)
            ident.append(d)
        alpha = np.full((width + 1, count), NEG)
        alpha[0] = 0
        step = np.zeros((width + 1, count), np.int8)
        for j in range(1, width + 1):
            best = alpha[j]
            for n in range(1, min(len(score), j) + 1):
                got = alpha[j - n] + score[n - 1][j - n]
                up = got > best
                np.copyto(best, got, where=up)
                step[j][up] = n
        beta = np.full((width + 1, count), NEG)
        rows = np.arange(count)
        beta[sizes, rows] = 0
        for j in range(width - 1, -1, -1):
            for n in range(1, min(len(score), width - j) + 1):
                np.maximum(beta[j], score[n - 1][j] + beta[j + n], out=beta[j])
        total = alpha[sizes, rows]
        place = sizes.copy()
        steps: list[np.ndarray] = []
        live = rows
        while len(live):
            n = step[place[live], live].astype(np.int64)
            start = place[live] - n
            took = np.full(count, -2, np.int32)
            for k in np.unique(n):
                own = n == k
                took[live[own]] = ident[k - 1][start[own], live[own]]
                ident[k - 1][start[own], live[own]] = -3  # on the best path
            steps.append(took)
            place[live] = start
            live = live[start > 0]
        second = np.full(count, NEG)
        for n, s in enumerate(score, 1):
            through = alpha[: s.shape[0]] + s + beta[n:]
            through[ident[n - 1] == -3] = NEG
            np.maximum(second, through.max(0), out=second)
        gaps = np.where(second > NEG / 2, total - second, np.inf)
        paths = np.stack(steps[::-1], 1)
        odd = (paths == -1).any(1)
        used = paths != -2
        used[odd] = False
        self._keep([w for w, o in zip(words, odd.tolist(), strict=True) if not o], paths[used], used.sum(1)[~odd], total[~odd], gaps[~odd])
        for k in np.flatnonzero(odd).tolist():  # a character without a piece: walk the text to spell its bytes
            ids_: list[int] = []
            at = 0
            for i in paths[k].tolist():
                if i == -1:
                    ids_.extend(self.fallback(words[k][at]))
                    at += 1
                elif i >= 0:
                    ids_.append(i)
                    at += len(self.pieces[i])
            self._keep([words[k]], np.array(ids_), np.array([len(ids_)]), total[k : k + 1], gaps[k : k + 1])

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._ways: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}
        self._parts: list[tuple[np.ndarray, ...]] = []
        self._pool = np.zeros(0, np.int32)
        self._sizes, self._starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._totals, self._gaps = np.zeros(0), np.zeros(0)

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray, totals: np.ndarray, gaps: np.ndarray) -> None:
        n = len(self._index)
        self._index.update(zip(words, range(n, n + len(words)), strict=True))
        self._parts.append((ids.astype(np.int32), sizes.astype(np.int64), totals, gaps))

    def learn(self, segments: set[str]) -> None:
        """Have the best segmentation, its score and the gap to the second best of each of these segments at hand."""
        if len(self._index) > _CACHE:
            self._clear()
        new = [s for s in segments if s not in self._index]
        new.sort(key=len)
        short = [s for s in new if len(s) <= _WIDE]
        for k in range(0, len(short), 4096):
            self._vector(short[k : k + 4096])
        for s in new[len(short) :]:
            two = self.nbest(s, 2)
            gap = two[0][0] - two[1][0] if len(two) > 1 else np.inf
            self._keep([s], np.array(two[0][1]), np.array([len(two[0][1])]), np.array([two[0][0]]), np.array([gap]))
        if self._parts:
            ids, sizes, totals, gaps = (np.concatenate(x) for x in zip(*self._parts, strict=True))
            self._parts.clear()
            if self.merges:
                words = list(islice(self._index, len(self._sizes), None))
                own = self.own_ids(words)
                own_sizes = np.fromiter(map(len, own), np.int64, len(own))
                flat = np.fromiter(chain.from_iterable(own), np.int32, int(own_sizes.sum()))
                same = sizes == own_sizes
                alike = ids[np.repeat(same, sizes)] == flat[np.repeat(same, own_sizes)]
                which = np.repeat(np.flatnonzero(same), sizes[same])
                same[which[~alike]] = False
                # the lattice's best is the first alternative where the merges give another
                gaps = np.where(same, gaps, 0.0)
                ids, sizes = flat, own_sizes
            self._pool = np.concatenate([self._pool, ids])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._starts = np.concatenate([[0], np.cumsum(self._sizes)])
            self._totals = np.concatenate([self._totals, totals])
            self._gaps = np.concatenate([self._gaps, gaps])

    def best(self, segment: str) -> tuple[tuple[int, ...], float, float]:
        """Ids, score and gap of a segment that ``learn`` has seen."""
        k = self._index[segment]
        ids = self._pool[self._starts[k] : self._starts[k + 1]]
        return tuple(ids.tolist()), float(self._totals[k]), float(self._gaps[k])

    def encode(self, segments: list[str], n: int) -> list[tuple[float, np.ndarray]]:
        """The ``n`` best segmentations of a text given as segments that ``learn`` has seen.

        Only the n - 1 segments with the smallest gaps can differ from their best form in the n best. Their own N-best
        lists come from A-star over their lattices, and A-star over this chain of choices joins them; totals tie in
        favour of fewer, then earlier changes.
        """
        if not segments:
            return [(0.0, np.zeros(0, np.int32))]
        at = np.fromiter(map(self._index.__getitem__, segments), np.int64, len(segments))
        sizes = self._sizes[at]
        ends = np.cumsum(sizes)
        ids = self._pool[np.repeat(self._starts[at] - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
        total = float(self._totals[at].sum())
        if n == 1:
            return [(total, ids)]
        gaps = self._gaps[at]
        if len(gaps) > 4 * n:
            near = np.flatnonzero(gaps <= np.partition(gaps, n - 2)[n - 2])
            active = near[np.argsort(gaps[near], kind="stable")][: n - 1]
        else:
            active = np.argsort(gaps, kind="stable")[: n - 1]
        active = sorted(k for k in active.tolist() if np.isfinite(gaps[k]))
        choices = []
        for k in active:
            key = (segments[k], n)
            ways = self._ways.get(key)
            if ways is None:
                found = self.nbest(*key)
                first = self.best(segments[k])[0]
                # the form at hand leads: the library's, or of equally good ones the Viterbi search's
                ways = [(0.0, first)] + [(found[0][0] - w, p) for w, p in found if p != first][: n - 1]
                self._ways[key] = ways
            choices.append(ways)
        # backward A-star over the chain; the cost still to come is 0 in each segment's best form
        heap: list[tuple] = [(0.0, 0, (), len(active))]
        done: list[tuple[float, dict[int, tuple[int, ...]]]] = []
        while heap and len(done) < n:
            cost, changes, path, place = heapq.heappop(heap)
            if place == 0:
                done.append((total - cost, {active[k]: choices[k][c][1] for k, c in path}))
                continue
            for c, (extra, _) in enumerate(choices[place - 1]):
                heapq.heappush(heap, (cost + extra, changes + (c > 0), ((place - 1, c), *path) if c else path, place - 1))
        out = []
        for value, changed in done:
            if not changed:
                out.append((value, ids))
                continue
            parts, begin = [], 0
            for k, form in sorted(changed.items()):
                parts += [ids[begin : ends[k] - sizes[k]], np.array(form, np.int32)]
                begin = int(ends[k])
            out.append((value, np.concatenate([*parts, ids[begin:]])))
        return out

    def spell(self, ids: np.ndarray) -> str:
        """``decode`` for an array of ids: one gather over the bytes of all pieces."""
        if self._spelt is None:
            sizes = np.fromiter(map(len, self.out), np.int64, len(self.out))
            self._spelt = (np.frombuffer(b"".join(self.out), np.uint8), np.cumsum(sizes) - sizes, sizes)
        pool, starts, sizes = self._spelt
        n = sizes[ids]
        ends = np.cumsum(n)
        raw = pool[np.repeat(starts[ids] - (ends - n), n) + np.arange(int(ends[-1]))] if len(ids) else pool[:0]
        text = raw.tobytes().decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids; bytes that are not UTF-8 become replacement characters."""
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MODELS: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    return _MODELS.get(path) or _MODELS.setdefault(path, PieceModel(path))


def encode(
    docs: DataFrame, model: str, *, text_col: str = "text", n_best: int = 4, full: bool = False, check: bool = False
) -> DataFrame:
    """``docs`` with ``piece_ids, n_pieces, piece_score, nbest_scores, nbest_crc`` (and ``nbest_ids`` if ``full``, and
    with ``check`` the boolean ``round_trip``: whether the ids decode to the text, its word marks as spaces).

    ``piece_ids`` is the best segmentation of the whole normalised text, the one that the library gives. For a unigram
    file it has the best score; for a BPE file it leads whatever the score, and counts as the best (see the module).
    ``nbest_scores`` holds the scores of the ``n_best`` best, descending; ``nbest_crc`` the CRC-32 of each as little-endian 32-bit ids. Characters without a
    piece become byte pieces at the vocabulary's lowest score less 10. No shuffle; memory is bounded by a batch, one
    text's ids and a bounded cache.

    Null and empty texts have no pieces and one segmentation with score 0. Repeated rows are encoded alike. Input
    columns with the names of result columns are replaced; all others pass through.
    """
    added = [
        T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_pieces", T.LongType()),
        T.StructField("piece_score", T.DoubleType()),
        T.StructField("nbest_scores", T.ArrayType(T.DoubleType())),
        T.StructField("nbest_crc", T.ArrayType(T.LongType())),
        *([T.StructField("nbest_ids", T.ArrayType(T.ArrayType(T.IntegerType())))] if full else []),
        *([T.StructField("round_trip", T.BooleanType())] if check else []),
    ]
    docs = replacing(docs, [f.name for f in added])
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in (b.slice(k, 250) for b in batches for k in range(0, b.num_rows, 250)):
            texts = batch.column(where).to_pylist()
            cut = [m.segments(m.normalize(t or "")) for t in texts]
            m.learn({s for segments in cut for s in segments})
            got = [m.encode(segments, n_best) for segments in cut]
            lists = [g[0][1] for g in got]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            cols = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                pa.array([len(x) for x in lists], pa.int64()),
                pa.array([g[0][0] for g in got], pa.float64()),
                pa.array([[s for s, _ in g] for g in got], pa.list_(pa.float64())),
                pa.array([[zlib.crc32(x.astype("<i4").tobytes()) for _, x in g] for g in got], pa.list_(pa.int64())),
            ]
            if full:
                cols.append(pa.array([[x.tolist() for _, x in g] for g in got], pa.list_(pa.list_(pa.int32()))))
            if check:
                cols.append(pa.array([m.spell(x) == (t or "").replace(MARK, " ") for x, t in zip(lists, texts, strict=True)]))
            names = [*batch.schema.names, *(f.name for f in added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def decode(rows: DataFrame, model: str, *, ids_col: str = "piece_ids") -> DataFrame:
    """``rows`` with ``decoded_text``, the text that the ids spell. Null ids give null; an existing column of that
    name is replaced."""
    rows = replacing(rows, ["decoded_text"])
    where = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in (b.slice(k, 250) for b in batches for k in range(0, b.num_rows, 250)):
            texts = [None if ids is None else m.decode(ids) for ids in batch.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded_text"]
            )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded_text", T.StringType())]))
