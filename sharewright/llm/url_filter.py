"""URL filter: all glob rules run at once as one bit-parallel automaton over each canonical URL.

A rule becomes a run of bits: bit 0 is "nothing read", bit k is "k signs read"; a wildcard keeps its bit alive. The bits of
all rules are packed into 64-bit words, and one shift, one mask and one self-loop mask per sign advance every rule.
Globs: ``*`` any signs but ``/``, ``**`` any signs, ``^`` one of ``. - / ?``; other signs stand for themselves. Base rules and
host words see the host only with their ``*``: it stops at ``?`` too.
The canonical URL is ``.host/path?query``: host lower-cased (A-Z), fragment dropped. A host word fits where it stands between
dots, hyphens or the ends of the host.

Null or URL without ``://``: host and path empty, no base rule fits, and the canonical URL is a single dot. Repeated rows are
judged alike, extra columns are ignored, an empty table gives an empty result. URLs of any length are read to their end, one
step a sign for all URLs of a batch together.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: verdict, host, path: fixed rules of the base; the longest that fits wins.
BASE_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Globs of the method for URLs without a base rule: they block; all else is allowed.
OWN_RULES = ["**.ads.**", "**/wp-login**", "**/cgi-bin/**", "**.exe", "**.zip", "**?**sessionid=**", "**/tracker/*"]
#: Words of the method that block a host which has one of them as a whole part, whatever its domain.
HOST_WORDS = ["ads", "adult", "bets", "betting", "casino", "escort", "pharmacy", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx"]
_SEPARATORS = ".-/?"

SCHEMA = "page_id string, host string, path string, rule string, verdict string, own_rule string"


class GlobAutomaton:
    """Multiword Shift-And over a list of globs; in the first ``n_host`` of them ``*`` stops at ``?`` as well."""

    def __init__(self, globs: list[str], n_host: int = 0):
        self.globs = globs
        parsed = [self._parse(g) for g in globs]
        width = sum(len(signs) + 1 for signs, _ in parsed)
        self.n_words = max(1, (width + 63) // 64)
        letters = sorted({s for signs, _ in parsed for s in signs} - {"^"} | set(_SEPARATORS))
        self.letters = np.array([ord(c) for c in letters], dtype=np.uint32)
        # sign 0 stands for every sign no glob names
        step, loop = self._zero(len(letters) + 1), self._zero(len(letters) + 1)
        start, last, self.final = self._zero(1)[0], self._zero(1)[0], []
        bit = 0
        for number, (signs, loops) in enumerate(parsed):
            stops = "/?" if number < n_host else "/"
            self._set(start, bit)
            for k in range(len(signs) + 1):
                if k in loops:
                    for s in range(len(letters) + 1):
                        if loops[k] == "any" or s == 0 or letters[s - 1] not in stops:
                            self._set(loop[s], bit + k)
                if k:
                    for s in range(len(letters) + 1):
                        if s and (letters[s - 1] == signs[k - 1] or signs[k - 1] == "^" and letters[s - 1] in _SEPARATORS):
                            self._set(step[s], bit + k)
            bit += len(signs)
            self._set(last, bit)
            self.final.append((bit // 64, np.uint64(1) << np.uint64(bit % 64)))
            bit += 1
        self.step, self.loop, self.start, self.carry_on = step, loop, start, ~last

    @staticmethod
    def _parse(glob):
        signs, loops, i = [], {}, 0
        while i < len(glob):
            if glob.startswith("**", i):
                loops[len(signs)] = "any"
                i += 2
            elif glob[i] == "*":
                loops.setdefault(len(signs), "segment")
                i += 1
            else:
                signs.append(glob[i])
                i += 1
        return signs, loops

    def _zero(self, rows):
        return np.zeros((rows, self.n_words), dtype=np.uint64)

    @staticmethod
    def _set(row, bit):
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def accepts(self, urls: list[str]) -> np.ndarray:
        """Matrix (URL, glob) of the globs that match each whole URL."""
        lengths = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self.start, (len(urls), 1))
        codes = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        near = np.searchsorted(self.letters, codes)
        near[near == len(self.letters)] = 0
        signs = np.where(self.letters[near] == codes, near + 1, 0)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(urls) else lengths
        ranked = lengths[order]
        one, top = np.uint64(1), np.uint64(63)
        for place in range(int(ranked[0]) if len(urls) else 0):
            live = order[:np.searchsorted(-ranked, -place, side="left")]
            sign = signs[begin[live] + place]
            moving = state[live] & self.carry_on
            shifted = moving << one
            shifted[:, 1:] |= moving[:, :-1] >> top
            state[live] = (shifted & self.step[sign]) | (state[live] & self.loop[sign])
        return np.stack([(state[:, w] & mask) != 0 for w, mask in self.final], axis=1)


def filter_urls(pages: DataFrame, base=BASE_RULES, own=OWN_RULES, host_words=HOST_WORDS) -> DataFrame:
    """Verdict of every URL; map-only, the rules are a bounded parameter. own_rule: the first own glob or ``host:word``."""
    base = sorted(base, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1], r[2]))
    words = [(f"host:{w}", glob) for w in host_words for glob in (f"*.{w}^**", f"*-{w}^**", f"*.{w}", f"*-{w}")]
    hosts = [f"*.{host}{path}**" for _, host, path in base] + [glob for _, glob in words]
    automaton = GlobAutomaton(hosts + list(own), len(hosts))
    n = len(base)
    # globs of the own rules come first among the names, as they did before there were host words
    own = [(len(hosts) + i, glob) for i, glob in enumerate(own)] + [(n + i, name) for i, (name, _) in enumerate(words)]

    def judge(batches):
        for batch in batches:
            hit = automaton.accepts(list(batch["canonical"]))
            rule, verdict, own_rule = [], [], []
            for row in hit:
                first = next((i for i in range(n) if row[i]), None)
                mine = next((name for i, name in own if row[i]), None)
                rule.append(None if first is None else base[first][1] + base[first][2])
                verdict.append(base[first][0] if first is not None else "block" if mine is not None else "allow")
                own_rule.append(mine)
            yield pd.DataFrame({"page_id": batch["page_id"], "host": batch["host"],
                                "path": batch["path"], "rule": pd.Series(rule, dtype=object),
                                "verdict": pd.Series(verdict, dtype=object),
                                "own_rule": pd.Series(own_rule, dtype=object)})

    rest = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end")
    parts = pages.select(F.col("page_id").cast("string"), F.coalesce(rest, F.lit("")).alias("rest")).select(
        "page_id",
        F.translate(F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                    "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract("rest", r"(?s)^[^?#]*(\?[^#]*)", 1).alias("query"),
    )
    return parts.withColumn("canonical", F.concat(F.lit("."), "host", "path", "query")).mapInPandas(
        judge, SCHEMA).withColumn("page_id", F.col("page_id").cast("long"))
