"""Text functions over columns, and the plain-string helpers that options need."""

from __future__ import annotations

import base64
import binascii

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what stays of an error log of which everything had to go.
REDACTED = "Data validation errors detected. Row data has been redacted for security."

#: Fixed value: where an abort reason names the error log.
ERROR_LOG_URL = r"(?i)(?:Tracking URL:|The tracking url:)\s+(https?://\S*/api/_load_error_log\?file=error_log_[0-9a-fA-F]+_[0-9a-fA-F]+)"

#: Load failures that no retry can mend.
FINAL_FAILURES = (
    "too many filtered rows",
    "primary key size exceed the limit",
    "only primary key table support partial update",
    "access denied",
    "current running txns on db",
)


def parse_delimiter(text: str | None, default: str | None = None, *, zero_x: bool = True) -> str:
    """A delimiter option: as it is, or bytes in hex after ``\\x`` (and ``0x``), one character a byte."""
    if not text:
        if default is None:
            raise ValueError("a delimiter is neither null nor empty")
        return default
    if text[:2].lower() not in (("\\x", "0x") if zero_x else ("\\x",)):
        return text
    digits = text[2:]
    if not digits:
        raise ValueError(f"delimiter {text!r}: no hex digits")
    try:
        return binascii.unhexlify(digits).decode("latin-1")
    except (binascii.Error, ValueError) as e:
        raise ValueError(f"delimiter {text!r}: hex digits come in pairs of 0-9 and A-F") from e


def delimiter(c: Column, default: str) -> Column:
    """``parse_delimiter`` over a column; malformed hex gives null."""
    given = F.coalesce(F.nullif(c, F.lit("")), F.lit(default))
    digits = F.substr(given, F.lit(3))
    well_formed = digits.rlike("^([0-9A-Fa-f]{2})+$")
    raw = F.decode(F.unhex(F.when(well_formed, digits)), "ISO-8859-1")
    return F.when(F.lower(F.left(given, F.lit(2))).isin("\\x", "0x"), raw).otherwise(given)


def quote_ident(name: str) -> str:
    return "`" + name.strip().replace("`", "") + "`"


def quoted(c: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(F.trim(c), F.lit("`"), F.lit("")), F.lit("`"))


def table_key(database: Column, table: Column) -> Column:
    return F.concat_ws("-", database, table)


def sanitize_error_log(c: Column) -> Column:
    """An error log without row data and column values: line by line, quoted values after ``Value`` become
    ``column value``, everything from ``Row:`` on goes, blank lines go; a log that is blank then says so."""
    lines = F.split(c, "\r?\n|\r")

    def clean(line: Column) -> Column:
        for quote in ("''[^']*''", "'[^']*'", '"[^"]*"'):
            line = F.regexp_replace(line, r"Value\s+" + quote, "column value")
        return F.regexp_replace(line, r"Row:\s*.*$", "")

    kept = F.filter(F.transform(lines, clean), lambda x: F.trim(x) != "")
    whole = F.trim(F.array_join(kept, "\n"))
    return F.when(c.isNull() | (F.trim(F.regexp_replace(c, r"[\r\n\t]", " ")) == ""), c).otherwise(
        F.when(whole == "", F.lit(REDACTED)).otherwise(whole)
    )


def error_log_url(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, ERROR_LOG_URL, 1), F.lit(""))


def parse_version(c: Column) -> Column:
    """``struct(major, minor, patch)`` of a text that starts like 1.2.3, else null."""
    pattern = r"^(\d+)\.(\d+)\.(\d+)"
    text = F.trim(c)
    number = lambda k: F.regexp_extract(text, pattern, k).cast("int")
    return F.when(text.rlike(pattern), F.struct(*[number(k).alias(n) for k, n in ((1, "major"), (2, "minor"), (3, "patch"))]))


def clear_brackets(c: Column) -> Column:
    """Balanced groups of round brackets removed, however deep; brackets without a partner stay."""
    tokens = F.regexp_extract_all(c, F.lit(r"[()]|[^()]+"), 0)

    def step(open_: Column, token: Column) -> Column:
        # texts since each bracket that is still open, the outermost first
        rest = F.slice(open_, 1, F.size(open_) - 1)
        longer = F.concat(rest, F.array(F.concat(F.element_at(open_, -1), token)))
        closed = F.when(F.size(open_) > 1, rest).otherwise(longer)
        return F.when(token == "(", F.concat(open_, F.array(F.lit("")))).when(token == ")", closed).otherwise(longer)

    return F.when(c.isNotNull(), F.aggregate(tokens, F.array(F.lit("")), step, lambda open_: F.array_join(open_, "(")))


def pad_zeros(c: Column, length: int) -> Column:
    """Zeros on the right up to a length; longer text stays whole."""
    return F.when(F.char_length(c) < length, F.rpad(c, length, "0")).otherwise(c)


def bytes_to_long(c: Column) -> Column:
    """The big-endian number of up to 8 bytes, wrapping into the sign as 64 bits do; no bytes are 0. The last 8 bytes are
    a ``substring``, which counts bytes of a binary; ``right`` would read them as UTF-8."""
    return F.when(F.octet_length(c) == 0, F.lit(0).cast("long")).when(
        c.isNotNull(), F.conv(F.hex(F.substring(c, -8, 8)), 16, -10).cast("long")
    )


def json_or_string(c: Column) -> Column:
    """As a variant: texts that start with a brace or bracket are parsed as JSON, all others stay strings."""
    as_json = F.try_parse_json(c)
    as_string = F.parse_json(F.to_json(F.array(c)))
    quoted_text = F.variant_get(as_string, "$[0]", "variant")
    return F.when(c.rlike(r"^[\[{]") & as_json.isNotNull(), as_json).otherwise(quoted_text)


def basic_auth(user: str, password: str) -> str:
    return "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()


def is_retryable(status: Column, message: Column) -> Column:
    """Whether a failed load may be tried again. A transaction still in processing always may; statuses other than a
    plain failure or internal error never; failures whose message names a lasting cause may not."""
    state = F.upper(F.coalesce(status, F.lit("")))
    lasting = F.lit(False)
    for words in FINAL_FAILURES:
        lasting = lasting | F.contains(F.lower(F.coalesce(message, F.lit(""))), F.lit(words))
    plain = state.isin("FAIL", "FAILED", "INTERNAL_ERROR", "INTERNAL ERROR")
    return F.when(state == "TXN_IN_PROCESSING", True).otherwise(plain & ~lasting)
