"""URL filter: all glob rules as one bit-parallel wildcard automaton over each canonical URL.

The states of every pattern lie side by side in one vector of 64-bit words (multiword Shift-And). A step shifts the
vector, keeps the states whose letter matches, and keeps states under a ``*`` where they are; all patterns advance
at once, for a whole batch of URLs at once.

Globs match the whole canonical URL ``host/path``; ``*`` stands for any bytes, ``?`` for one byte; all other bytes stand
for themselves. In the rules for domains the subdomains are bytes other than ``/``, so that the host's end is the rule's and
the path starts with the rule's path. Defined results: a null URL or one without ``://`` has an empty host and path and fits no rule;
repeated URLs get the same verdict; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed rules of the contract: (verdict, host suffix, path prefix).
CONTRACT_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Globs of the method itself, for URLs that no rule fits: hosts with a spam word, and bare address hosts with a port.
SPAM_GLOBS = ("*spam-*/*", "*-spam*/*", "*cheap-*/*", "*-pills*/*", "*casino*/*", "*free-money*/*", "*:*/*.exe")


#: A wildcard for any bytes but ``/``.
WITHIN = "\0"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    globs: tuple[str, ...]
    rank: int  # a rule of higher rank wins


def domain_rules(rules=CONTRACT_RULES) -> list[Rule]:
    """Rules for a host with its subdomains and a path prefix, as globs; longer ones rank higher."""
    return [Rule(f"{host}{path}", verdict, (f"{_literal(host)}{_literal(path)}*", f"{WITHIN}.{_literal(host)}{_literal(path)}*"), 1000 + len(host) + len(path)) for verdict, host, path in rules]


def _literal(s: str) -> str:
    if "*" in s or "?" in s or WITHIN in s:
        raise ValueError(f"a wildcard in a literal part of a rule: {s}")
    return s


class GlobAutomaton:
    """Multiword Shift-And over all globs of ``rules``."""

    def __init__(self, rules: list[Rule]):
        bits: list[tuple[int, int, int]] = []  # (letter or -1 any or -2 start, pattern, stays: 0 no, 1 yes, 2 until a /)
        self.accept: list[tuple[int, int]] = []  # (bit, rule)
        starts = []
        for r, rule in enumerate(rules):
            for glob in rule.globs:
                starts.append(len(bits))
                bits.append((-2, r, 0))
                for c in glob.encode():
                    if c in (42, 0):
                        bits[-1] = (bits[-1][0], r, 1 if c == 42 else bits[-1][2] or 2)
                    else:
                        bits.append((-1 if c == 63 else c, r, 0))
                self.accept.append((len(bits) - 1, r))
        self.words = max(1, -(-len(bits) // 64))
        self.match = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.init = np.zeros(self.words, np.uint64)
        for i, (letter, _, stays) in enumerate(bits):
            w, one = i // 64, np.uint64(1 << (i % 64))
            if stays:
                self.stay[:, w] |= one
            if stays == 2:
                self.stay[47, w] &= ~one
            if letter == -1:
                self.match[:, w] |= one
            elif letter >= 0:
                self.match[letter, w] |= one
        for i in starts:
            self.init[i // 64] |= np.uint64(1 << (i % 64))

    def run(self, urls: list[bytes]) -> np.ndarray:
        """A matrix urls x accepting bits."""
        n = len(urls)
        out = np.zeros((n, len(self.accept)), bool)
        order = np.argsort([-len(u) for u in urls], kind="stable")
        size = np.array([len(urls[i]) for i in order], np.int64)
        buf = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
        at = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
        state = np.tile(self.init, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        live = n
        for k in range(int(size[0]) if n else 0):
            live = int(np.searchsorted(-size, -k, side="left"))  # URLs longer than k; they come first
            s = state[:live]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            letter = buf[at[:live] + k]
            state[:live] = (moved & self.match[letter]) | (s & self.stay[letter])
        for j, (bit, _) in enumerate(self.accept):
            out[order, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one != 0
        return out


def judge(pages: DataFrame, rules: list[Rule] | None = None, spam_globs: tuple[str, ...] = SPAM_GLOBS, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page id, host, path, rule (null: none fits) and verdict; the method's globs judge what no rule fits."""
    named = domain_rules() if rules is None else rules
    every = [*named, *(Rule(g, "block", (g,), 0) for g in spam_globs)]
    n_named = len(named)
    url = F.col(url_col).cast("string")
    #: after the first ://, host up to / ? # or the end, path then up to ? # or the end
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    df = pages.select(F.col(id_col), rest.alias("rest")).select(id_col, F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1).alias("host"), F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))
    df = df.withColumn("host", F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    def run(batches):
        auto = GlobAutomaton(every)
        owner = np.array([r for _, r in auto.accept])
        for b in batches:
            hosts, paths = b.column("host").to_pylist(), b.column("path").to_pylist()
            hit = np.zeros((len(hosts), len(every)), bool)
            found = auto.run([(h + p).encode("utf-8", "surrogatepass") if h or p else b"" for h, p in zip(hosts, paths, strict=True)])
            for j, r in enumerate(owner):
                hit[:, r] |= found[:, j]
            rank = np.array([r.rank for r in every])
            best = np.where(hit, rank[None, :] + 1, 0)
            who = best.argmax(axis=1)
            some = best.max(axis=1) > 0
            rule = [every[w].name if s and w < n_named else None for w, s in zip(who, some, strict=True)]
            verdict = [every[w].verdict if s else "allow" for w, s in zip(who, some, strict=True)]
            glob = [every[w].name if s and w >= n_named else None for w, s in zip(who, some, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(id_col), b.column("host"), b.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(glob, pa.string())], names=[id_col, "host", "path", "rule", "verdict", "glob"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, glob string")


ORACLE_SQL = """
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT *, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
  CASE
  WHEN host || path LIKE '%spam-%/%' THEN '*spam-*/*' WHEN host || path LIKE '%-spam%/%' THEN '*-spam*/*'
  WHEN host || path LIKE '%cheap-%/%' THEN '*cheap-*/*' WHEN host || path LIKE '%-pills%/%' THEN '*-pills*/*'
  WHEN host || path LIKE '%casino%/%' THEN '*casino*/*' WHEN host || path LIKE '%free-money%/%' THEN '*free-money*/*'
  WHEN host || path LIKE '%:%/%.exe' THEN '*:*/*.exe' END AS g FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR g IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN g END AS glob
FROM j
"""
