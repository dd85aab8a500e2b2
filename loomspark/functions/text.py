"""Text expressions with the string semantics of the records this library handles: Unicode white space and line ends."""

from __future__ import annotations

from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed class: the white space of the data's text rules, as a Java regular expression.
WS = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
NOT_WS = "[^" + WS[1:]
#: Fixed class: line ends; a carriage return with a line feed is one.
EOL = r"\r\n|[\n-\r\x1c-\x1e\x85  ]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The characters of ``WS``.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def squeeze(c: Column | str) -> Column:
    """Without outer white space, inner runs as one space; one pass of the pattern, then a plain trim."""
    return F.trim(F.regexp_replace(col(c), f"{WS}+", " "))


def without_space(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"{WS}+", "")


def lines(c: Column | str) -> Column:
    """Lines of a text; a final line end starts no line."""
    a = F.split(col(c), EOL, -1)
    return F.when(F.element_at(a, -1) == "", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)


def newlines(c: Column | str) -> Column:
    """The text with each line end as one line feed."""
    return F.translate(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029", "\n" * 9)


def n_lines(nl: Column) -> Column:
    """Lines of a text with plain line ends."""
    return F.length(nl) - F.length(F.replace(nl, F.lit("\n"), F.lit(""))) + F.when((nl == "") | F.endswith(nl, F.lit("\n")), 0).otherwise(1)


def n_solid(nl: Column) -> Column:
    """Lines that aren't blank, of a text with plain line ends: each is a match from its first solid character on."""
    return F.regexp_count(nl, F.lit(f"{NOT_WS}[^\n]*+"))


def lines_with(nl: Column, pattern: str) -> Column:
    """Lines that have a match, of a text with plain line ends: a match takes the rest of its line."""
    return F.regexp_count(nl, F.lit(f"(?:{pattern})[^\n]*+"))


def estimated_tokens(c: Column | str) -> Column:
    """A quarter of the code points, rounded up; 0 for an empty text."""
    return F.ceil(F.length(col(c)) / 4).cast("long")


def count_of(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern))


def has_any(c: Column | str, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(col(c), F.lit(p))
    return out


def hits(c: Column | str, parts: tuple[str, ...]) -> Column:
    """How many of the parts a text has."""
    return sum((F.contains(col(c), F.lit(p)).cast("int") for p in parts), F.lit(0))


ROWS = 100  # texts of a batch that are strings at a time
STATS = pa.struct({"n": pa.int32(), "top": pa.int32(), "entropy": pa.float64(), "solid": pa.int32(), "once": pa.int32()})


def _stats(text: str | None) -> dict:
    own = [x for x in map(str.strip, (text or "").splitlines()) if x]
    seen, lines = Counter("".join((text or "").split())), Counter(own)
    n = seen.total()
    entropy = -sum(k / n * log2(k / n) for k in seen.values()) if n else 0.0
    return {"n": n, "top": max(seen.values(), default=0), "entropy": entropy, "solid": len(own), "once": sum(k == 1 for k in lines.values())}


def stats_of(texts: pa.Array) -> pa.Array:
    """The statistics of a batch of texts, ``ROWS`` of which are strings at a time."""
    parts = [pa.array(map(_stats, texts.slice(lo, ROWS).to_pylist()), STATS) for lo in range(0, len(texts), ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], STATS)


def stats(c: Column | str) -> Column:
    """(n, top, entropy) of a text's characters without white space, (solid, once) of its lines that aren't blank: histograms in
    one pass over an Arrow batch. Built-in functions would sort or explode every character."""

    @F.arrow_udf("n int, top int, entropy double, solid int, once int")
    def of(texts: pa.Array) -> pa.Array:
        return stats_of(texts)

    return of(col(c))


# The same in the dialect the results are compared in.
SQL_WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL_EOL = r"\r\n|[\n-\r\x1c-\x1e\x85\x{2028}\x{2029}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace({sql_strip(x)}, '{SQL_WS}+', ' ', 'g')"


def sql_lines(x: str) -> str:
    a = f"regexp_split_to_array({x}, '{SQL_EOL}')"
    return f"(CASE WHEN {a}[-1] = '' THEN {a}[1:len({a}) - 1] ELSE {a} END)"


def sql_solid(x: str) -> str:
    return f"list_filter(list_transform({sql_lines(x)}, lambda l: {sql_strip('l')}), lambda l: l <> '')"


def sql_quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_any(x: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, {sql_quote(p)})" for p in parts) + ")"


def sql_hits(x: str, parts: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"contains({x}, {sql_quote(p)})::INT" for p in parts) + ")"
