"""Token counts of whole texts; huge documents are encoded in overlapping chunks that are spliced again."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Normalizers and the pre-tokenizer pattern under which no token depends on text beyond white space.
SAFE_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_RUN = re.compile(r"[^ \t\n\x0b\x0c\r]+")
_CACHE_WORDS = 400_000


def splits_at_space(config: dict) -> bool:
    """Whether the tokenizer's own description proves that its tokens on both sides of ASCII white space are independent.

    It holds when white space is dropped by the pre-tokenizer, normalizers work within runs (canonical composition
    never joins across a space; runs of space become one), and no added token holds white space or strips it.
    """
    norm = config.get("normalizer") or {}
    steps = norm.get("normalizers", [norm]) if norm else []
    for s in steps:
        collapse = s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " "
        if s.get("type") not in SAFE_NORMALIZERS and not collapse:
            return False
    pre = config.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    drops = first.get("type") in ("WhitespaceSplit", "Whitespace") or (
        first.get("type") == "Split"
        and first.get("pattern") == {"Regex": WORD_PATTERN}
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
    )
    rest = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps[1:])
    added = all(not (t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"])) for t in config.get("added_tokens", []))
    return bool(drops and rest and added)


class Encoder:
    """The library's encoder for one vocabulary file, with a cache of runs of non-space where that is proven safe."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.sp = self.tok = None
        if path.endswith(".model"):
            import sentencepiece

            self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.separable = False
        else:
            from tokenizers import Tokenizer

            self.tok = Tokenizer.from_file(path)
            self.tok.no_truncation()
            self.tok.no_padding()
            with open(path, encoding="utf-8") as f:
                self.separable = splits_at_space(json.load(f))
        self._counts: dict[bytes, int] = {}
        self._starts: dict[str, tuple[int, ...]] = {}

    def count_whole(self, texts: list[str]) -> list[int]:
        if self.sp is not None:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        return [len(x) for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return self.count_whole(texts)
        split = [t.encode().split() for t in texts]
        known = self._counts
        if len(known) > _CACHE_WORDS:
            known.clear()
        new = list({w for words in split for w in words if w not in known})
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            known.update(zip(part, self.count_whole([w.decode() for w in part]), strict=True))
        return [sum(map(known.__getitem__, words)) for words in split]

    def starts(self, text: str, at: int) -> np.ndarray:
        """Places in the document, ``at`` being that of ``text``, where the tokens of ``text`` start."""
        if not self.separable:
            e = self.tok.encode(text, add_special_tokens=False)
            return np.fromiter((o[0] for o in e.offsets), np.int64, len(e.offsets)) + at
        known = self._starts
        if len(known) > _CACHE_WORDS // 4:
            known.clear()
        runs = [(m.start(), m.group()) for m in _RUN.finditer(text)]
        new = list({r for _, r in runs if r not in known})
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            for r, e in zip(part, self.tok.encode_batch(part, add_special_tokens=False), strict=True):
                known[r] = tuple(o[0] for o in e.offsets)
        got = [known[r] for _, r in runs]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        where = np.repeat(np.fromiter((p for p, _ in runs), np.int64, len(runs)), sizes)
        flat = np.fromiter((x for g in got for x in g), np.int64, int(sizes.sum()))
        return where + flat + at


def stable(text: str, p: int) -> bool:
    """A token that starts at ``p`` right after ASCII white space cannot depend on anything before ``p``."""
    return p > 0 and text[p - 1] in " \t\n\r"


def count_resync(text: str, encoder: Encoder, chunk: int, overlap: int, agree: int = 8) -> tuple[int, int]:
    """Tokens of a huge text and how often an overlap was widened.

    Chunks of ``chunk`` characters overlap by ``overlap``. Two chunks are spliced at a place where both start a token,
    that is stable, and from which both agree on the next ``agree`` tokens. Without one, the next chunk starts earlier
    by twice the overlap, at last where the current one started; then the current chunk grows instead, up to the
    whole rest of the text.
    """
    n, total, widened = len(text), 0, 0
    begin, end, size = 0, min(chunk, len(text)), chunk
    here = encoder.starts(text[begin:end], begin)
    while end < n:
        back = overlap
        splice = None
        while True:
            start = max(begin, end - back)
            ahead = min(n, start + size)
            there = encoder.starts(text[start:ahead], start) if start > begin else None
            if there is not None:
                mine = here[here > start]
                both = np.intersect1d(mine, there, assume_unique=False)
                a, b = np.searchsorted(here, both), np.searchsorted(there, both)
                for p, i, j in zip(both.tolist(), a.tolist(), b.tolist(), strict=True):
                    if i + agree >= len(here) or j + agree > len(there):
                        break  # too near the end of this chunk
                    if stable(text, p) and np.array_equal(here[i : i + agree], there[j : j + agree]):
                        splice = (p, i, j)
                        break
            if splice or start <= begin:
                break
            widened += 1
            back *= 2
        if splice:
            total += splice[1]
            begin, end, size = splice[0], ahead, chunk
            here = there[splice[2] :]
        else:  # nothing in common even with the whole chunk: take a longer chunk
            widened += 1
            size *= 2
            end = min(n, begin + size)
            here = encoder.starts(text[begin:end], begin)
    return total + len(here), widened


_ENCODERS: dict[str, Encoder] = {}


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    chunk: int = 32_768,
    overlap: int = 1_024,
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit, n_chunks_widened``.

    Counts are those of the library for ``tokenizer`` (tokenizers for .json, sentencepiece for .model) without added
    special tokens, truncation or padding. Texts over ``chunk`` characters are encoded in overlapping chunks with
    offsets and spliced at stable common boundaries (``count_resync``); memory is bounded by a chunk unless a text has
    no white space at all. Tokenizers that are not proven to split at white space, and sentencepiece models, encode
    whole texts. No shuffle.

    Null text is empty and has 0 tokens; null and repeated identifiers pass through; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, Encoder(tokenizer))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            huge = [k for k, t in enumerate(texts) if encoder.separable and len(t) > chunk]
            n = np.zeros(len(texts), np.int64)
            wide = np.zeros(len(texts), np.int64)
            rest = [k for k, t in enumerate(texts) if not (encoder.separable and len(t) > chunk)]
            n[rest] = encoder.count([texts[k] for k in rest])
            for k in huge:
                n[k], wide[k] = count_resync(texts[k], encoder, chunk, overlap)
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, pa.array(n), pa.array(n > limit), pa.array(wide)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks_widened"],
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks_widened long")
