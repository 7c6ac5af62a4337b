"""URL rules as one bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL, in which `*` stands for any run of characters without a slash and `**` for
any run at all. All globs are laid out one after another in the bits of a few 64-bit words. For each character, a shift
moves every pattern's matched prefixes on, a mask per character keeps those it fits, and a star's position holds its own
bit. The URLs of a batch advance together, longest first, so that those that have ended leave the front.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import raw

#: Rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


class Automaton:
    """Shift-And masks of globs; stars and nothing else are special."""

    def __init__(self, globs: list[str]):
        laid, stars, self.ends, size = [], [], [], 0
        begins = []
        for glob in globs:
            begins.append(size)  # a bit for "nothing read yet", then one for each unit matched
            for unit in re.findall(rb"\*+|[^*]", glob.encode(), re.DOTALL):
                size += 1
                (stars if unit[0] == 42 else laid).append((size, unit))
            self.ends.append(size)
            size += 1
        wide = max(1, -(-size // 64))
        self.step = np.zeros((256, wide), np.uint64)
        self.stay, self.star = np.zeros((256, wide), np.uint64), np.zeros(wide, np.uint64)
        self.begin = np.zeros(wide, np.uint64)
        for i, unit in laid:
            self._set(self.step[unit[0]], i)
        for i, unit in stars:
            self._set(self.star, i)
            for c in range(256):
                if c != 47 or len(unit) > 1:
                    self._set(self.stay[c], i)
        for i in begins:
            self._set(self.begin, i)

    @staticmethod
    def _set(row: np.ndarray, i: int) -> None:
        row[i // 64] |= np.uint64(1 << (i % 64))

    @staticmethod
    def _shift(state: np.ndarray) -> np.ndarray:
        out = state << np.uint64(1)
        out[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return out

    def match(self, texts: pa.Array) -> np.ndarray:
        """Rows of texts by globs: which glob fits which whole text."""
        data, at = raw(texts)
        order = np.argsort(at[:-1] - at[1:], kind="stable")
        length, begins = np.diff(at)[order], at[:-1][order]
        state = np.tile(self.begin, (len(order), 1))
        state |= self._shift(state) & self.star  # a star may stand for nothing
        live = len(order)
        for j in range(int(length[0]) if live else 0):
            while live and length[live - 1] <= j:
                live -= 1
            now = state[:live]
            c = data[begins[:live] + j]
            new = self._shift(now) & self.step[c] | now & self.stay[c]
            new |= self._shift(new) & self.star
            state[:live] = new
        out = np.zeros((len(order), len(self.ends)), bool)
        for k, end in enumerate(self.ends):
            out[order, k] = (state[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1) > 0
        return out


def judge(pages: DataFrame, rules=RULES, globs=(), default: str = "allow") -> DataFrame:
    """The pages with `host`, `path`, `rule` (the longest that fits, else NULL) and `verdict`.

    A rule (verdict, host, path) fits its host and all subdomains if the path begins as the rule's; of those that fit, the
    longest decides, then the first. `globs` are further (verdict, glob) over `host/path`, asked in order where no rule fits;
    `default` is the verdict where nothing does. The canonical URL is `.host/path`; a NULL url has host and path empty.
    """
    clash = {"host", "path", "rule", "verdict"} & set(pages.columns)
    kept = pages.drop(*clash)
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    rest = F.coalesce(F.substring_index(F.substring_index(rest, "#", 1), "?", 1), F.lit(""))
    host = F.translate(
        F.substring_index("__rest", "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    parts = kept.withColumn("__rest", rest).withColumns(
        {"host": host, "path": F.expr("substring(__rest, length(substring_index(__rest, '/', 1)) + 1)")}
    )
    patterns = [f"*.{h}{p}**" for _, h, p in rules] + [g for _, g in globs]
    rank = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2])) + [
        len(rules) + i for i in range(len(globs))
    ]
    machine = Automaton(patterns)

    def run(batches):
        for batch in batches:
            fits = machine.match(batch.column(batch.schema.get_field_index("__url")))
            ranked = fits[:, rank]
            hit = np.where(ranked.any(axis=1), np.array(rank + [-1])[ranked.argmax(axis=1)], -1) if rank else np.full(len(fits), -1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(hit.astype(np.int32))], [*batch.schema.names[:-1], "__hit"]
            )

    ready = parts.drop("__rest").withColumn("__url", F.concat(F.lit("."), "host", "path"))
    schema = ready.drop("__url").withColumn("__hit", F.lit(0)).schema
    found = ready.mapInArrow(run, schema)
    names = F.array(*[F.lit(h + p) for _, h, p in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(v) for v, *_ in [*rules, *globs]]) if rules or globs else F.array().cast("array<string>")
    return found.select(
        *[c for c in found.columns if c != "__hit"],
        F.get(names, F.col("__hit")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("__hit")), F.lit(default)).alias("verdict"),
    )
