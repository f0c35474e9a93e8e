"""License scan: winnowed fingerprints pick candidates, banded alignment confirms them.

The templates' word k-grams are winnowed (of each window of neighbours the smallest code is kept), so
that any shared run of ``window + k - 1`` words has a kept one in common; an inverted index leads
from a code to templates and places. Hits of a document that lie near one diagonal are a candidate,
and a banded local alignment of the words there gives the matched coverage of the template and the
span in the text. While hits of the candidate lie before or after the span, as where a notice stands twice
in a row, these parts of the text are aligned again. Of findings that overlap the one with more matched words stays.

Null and empty texts have no finding. Texts of any length are scanned whole; a text with many
notices gives as many rows. Repeated rows and null ids give their findings again. An empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import extended
from etalage.llm.license_templates import TEMPLATES

TOKEN = re.compile(r"\w+")
MATCH, MISMATCH, GAP = 2, -1, -1


class Index:
    """The vocabulary of the templates, their words as numbers, and where each kept k-gram occurs."""

    def __init__(self, templates: dict[str, str], k: int = 3, window: int = 2):
        self.names = list(templates)
        texts = [[w.lower() for w in TOKEN.findall(t)] for t in templates.values()]
        self.number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        self.k, self.base = k, len(self.number) + 1
        if self.base**k >= 1 << 62:
            raise ValueError("too many different words for k-grams of this length")
        self.words = [np.array([self.number[w] for w in t], np.int64) for t in texts]
        found = []
        for t, words in enumerate(self.words):
            codes = self.codes(words)
            # Codes are put in a mixed order: the smallest is then not always the first word's.
            mixed = (codes * 0x9E3779B1) % ((1 << 61) - 1)
            for at in range(max(len(codes) - window + 1, min(len(codes), 1))):
                found.append((t, at + int(np.argmin(mixed[at : at + window]))))
        kept = sorted(set(found))
        postings = sorted((int(self.codes(self.words[t])[j]), t, j) for t, j in kept)
        self.keys = np.array([c for c, _, _ in postings], np.int64)
        self.where = np.array([(t, j) for _, t, j in postings], np.int64).reshape(-1, 2)

    def codes(self, words: np.ndarray) -> np.ndarray:
        """A number for each k-gram, -1 where it has a word that is in no template."""
        n = len(words) - self.k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(self.k):
            part = words[i : i + n]
            out, known = out * self.base + part, known & (part > 0)
        return np.where(known, out, -1)

    def candidates(self, words: np.ndarray, band: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """Template, first diagonal and hits (diagonal, place) of each group of hits near one diagonal."""
        codes = self.codes(words)
        at = np.flatnonzero(codes >= 0)
        first, last = np.searchsorted(self.keys, codes[at]), np.searchsorted(self.keys, codes[at], "right")
        at, first, last = at[last > first], first[last > first], last[last > first]
        hits = sorted(
            (int(self.where[p, 0]), int(i) - int(self.where[p, 1]), int(i))
            for i, a, b in zip(at, first, last, strict=True)
            for p in range(a, b)
        )
        out: list[tuple[int, int, list[tuple[int, int]]]] = []
        for t, diagonal, i in hits:
            if not (out and out[-1][0] == t and diagonal - out[-1][1] <= band):
                out.append((t, diagonal, []))
            out[-1][2].append((diagonal, i))  # the band of the group's first diagonal has it
        return out

    def align(self, words: np.ndarray, t: int, diagonal: int, band: int) -> tuple[int, int, int]:
        """Matched words, and first and last word of the text, of the best local alignment in the band."""
        own = self.words[t].tolist()
        # Only what the band can reach of the text.
        low = max(0, diagonal - band)
        text = words[low : max(low, diagonal + len(own) + band)].tolist()
        n = low + len(text)
        width = 2 * band + 1
        score = [0] * (width + 2)
        # Of the best alignment that ends in a cell: matched words and where it begins.
        matched, begin = [0] * (width + 2), [-1] * (width + 2)
        best = (0, 0, -1, -1)
        for j, word in enumerate(own):
            now, now_matched, now_begin = [0] * (width + 2), [0] * (width + 2), [-1] * (width + 2)
            for b in range(1, width + 1):
                i = j + diagonal + b - 1 - band
                if not low <= i < n:
                    continue
                same = text[i - low] == word
                # From the cell before in both, in the template only, in the text only.
                x = score[b] + (MATCH if same else MISMATCH)
                y, z = score[b + 1] + GAP, now[b - 1] + GAP
                top = max(x, y, z, 0)
                if not top:
                    continue
                now[b] = top
                if x == top:
                    now_matched[b] = matched[b] + same
                    now_begin[b] = begin[b] if score[b] else i
                elif y == top:
                    now_matched[b], now_begin[b] = matched[b + 1], begin[b + 1]
                else:
                    now_matched[b], now_begin[b] = now_matched[b - 1], now_begin[b - 1]
                if top > best[0]:
                    best = (top, now_matched[b], now_begin[b], i)
            score, matched, begin = now, now_matched, now_begin
        return best[1:]

    def scan(self, words: np.ndarray, band: int, coverage: float) -> list[tuple[int, float, int, int, int]]:
        """Template, coverage, matched words, first and last word of every finding, in the text's order."""
        found = []
        for t, _, hits in self.candidates(words, band):
            # Parts of the text, and the hits that lie in them: at first all of it.
            parts = [(0, len(words), hits)]
            while parts:
                begin, end, own = parts.pop()
                diagonal = own[0][0]
                hit, first, last = self.align(words[begin:end], t, diagonal - begin, band)
                if not hit:
                    continue
                first, last = first + begin, last + begin
                if hit >= coverage * len(self.words[t]):
                    found.append((t, hit / len(self.words[t]), hit, first, last))
                for b, e in ((begin, first), (last + 1, end)):
                    left = [x for x in own if b <= x[1] and x[1] + self.k <= e]
                    if left:
                        parts.append((b, e, left))
        kept: list[tuple[int, float, int, int, int]] = []
        taken = np.zeros(len(words), bool)
        for x in sorted(set(found), key=lambda x: (-x[2], -x[1], x[0], x[3])):
            if not taken[x[3] : x[4] + 1].any():
                taken[x[3] : x[4] + 1] = True
                kept.append(x)
        return sorted(kept, key=lambda x: x[3])


def scan(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    templates: dict[str, str] | None = None,
    coverage: float = 0.8,
    band: int = 8,
) -> DataFrame:
    """A row for each finding: the columns ``keep``, license, coverage (share of the template's words that
    are matched), matched, template_words, and start and end of the span in the text (code points).

    The index, as large as the templates, goes to the tasks with the function. No row is moved.
    """
    index = Index(TEMPLATES if templates is None else templates)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    made = ["license", "coverage", "matched", "template_words", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.number.get
        for batch in batches:
            rows, out = [], []
            for r, doc in enumerate(batch.column(len(keep)).to_pylist()):
                words = np.array([number(w.lower(), 0) for w in TOKEN.findall(doc)], np.int64)
                found = index.scan(words, band, coverage) if words.any() else []
                if found:
                    spans = [m.span() for m in TOKEN.finditer(doc)]
                for t, share, hit, first, last in found:
                    rows.append(r)
                    out.append((index.names[t], share, hit, len(index.words[t]), spans[first][0], spans[last][1]))
            kinds = [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*keep, *made])

    schema = extended(
        rows.drop("_text").schema, "license string, coverage double, matched int, template_words int, start int, end int"
    )
    return rows.mapInArrow(run, schema)
