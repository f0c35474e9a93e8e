"""URL filter by glob rules, all simulated at once by a bit-parallel automaton.

A canonical URL is ``.host/path``: host in lower case, without scheme, query and fragment. A rule is
a glob over it: ``*`` stands for any characters but ``/``, ``**`` for any characters. All globs are
packed end to end into Shift-And masks of 64-bit words; one pass over a URL's bytes follows every
glob. Of the globs that reach their end, the one with the largest weight decides.

Null URLs and those without ``://`` have an empty host and path; their canonical form is ``.``.
Rows are independent: repeated rows and null ids are judged like any other; an empty table stays so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import extended


@dataclass(frozen=True)
class Rule:
    """A glob, what it decides, its name in the result (null if it has none) and its weight."""

    glob: str
    verdict: str
    name: str | None
    weight: int


def prefix_rule(verdict: str, host: str, path: str) -> Rule:
    """A host with all its subdomains, and the paths that start with ``path``; the longer rule weighs more."""
    return Rule(f"*.{host}{path}**", verdict, host + path, 1_000 + len(host + path))


class ShiftAnd:
    """The globs as one automaton. A state is a bit: so many literal bytes of a glob have been read.

    ``move[c]`` has the states that byte c leads to from the state before, ``stay[c]`` those with a
    wildcard that takes c. States lie glob after glob over as many 64-bit words as they need; the
    first state of a glob is in no ``move`` mask, so nothing passes from one glob to the next.
    """

    def __init__(self, globs: list[str]):
        literals, loops, starts, ends = [], [], [], []  # by state
        for glob in globs:
            starts.append(len(literals))
            literals.append(None)
            loops.append("")
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i : i + 1] == b"*":
                    double = raw[i : i + 2] == b"**"
                    loops[-1] = "**" if double or loops[-1] == "**" else "*"
                    i += 1 + double
                else:
                    literals.append(raw[i])
                    loops.append("")
                    i += 1
            ends.append(len(literals) - 1)
        self.words = words = max(1, -(-len(literals) // 64))
        self.move = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        for state, (literal, loop) in enumerate(zip(literals, loops, strict=True)):
            word, bit = state // 64, np.uint64(1 << (state % 64))
            if literal is not None:
                self.move[literal, word] |= bit
            if loop:
                takes = np.array([loop == "**" or c != ord("/") for c in range(256)])
                self.stay[takes, word] |= bit
        self.first = np.zeros(words, np.uint64)
        for state in starts:
            self.first[state // 64] |= np.uint64(1 << (state % 64))
        self.end_word = np.array([e // 64 for e in ends], np.int64)
        self.end_bit = np.array([e % 64 for e in ends], np.uint64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text and a column for each glob: whether the glob fits the whole text."""
        flat = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")  # texts that have ended are at the end
        begin, still = begin[order], -lengths[order]
        state = np.tile(self.first, (len(texts), 1))
        for step in range(int(lengths.max(initial=0))):
            active = int(np.searchsorted(still, -step, side="left"))
            c = flat[begin[:active] + step]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.move[c]) | (now & self.stay[c])
        fits = (state[:, self.end_word] >> self.end_bit) & np.uint64(1)
        out = np.empty((len(texts), len(self.end_bit)), bool)
        out[order] = fits.astype(bool)
        return out


def canonical(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL: the host from after the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, A-Z in lower case; the path from there up to ``?``, ``#`` or the end."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, "(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but those made here if not given), host, path, rule and verdict of every row.

    Of equal weights the rule listed first decides; where no glob fits, ``default`` does and rule is
    null. The masks depend on the rules alone and go to the tasks with the function.
    """
    made = ["host", "path", "rule", "verdict"]
    keep = [c for c in pages.columns if c not in made] if keep is None else keep
    host, path = canonical(F.col(f"`{url}`"))
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    ranked = sorted(rules, key=lambda r: -r.weight)
    automaton = ShiftAnd([r.glob for r in ranked])
    names = np.array([r.name for r in ranked] + [None], object)
    verdicts = np.array([r.verdict for r in ranked] + [default], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            fits = automaton.matches([f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)])
            which = np.argmax(np.c_[fits, np.ones(len(hosts), bool)], axis=1)
            found = [pa.array(names[which], pa.string()), pa.array(verdicts[which], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*keep, *made])

    return rows.mapInArrow(run, extended(rows.schema, "rule string, verdict string"))
