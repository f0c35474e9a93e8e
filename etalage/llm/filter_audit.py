"""What each filter of a chain removes, in every order of the chain.

Every document has a mask of the filters it fails. Per part, the masks are counted and become a decision
diagram: a level for each filter, a node for each distinct remainder, and the weight of all documents below
a node at that node. Two levels next to each other are swapped in place; walking all orders by such swaps
rewrites two levels at a time. In each order the path on which everything passes gives the steps: the branch
that leaves it holds what the filter removes there.

Cases. Null and empty text have no words and no characters. A null part is the part ''. Rows that repeat an id
count each; a text is a copy when a smaller id has the same bytes anywhere in the table, so rows without an
id, and rows that share the smallest id of a text, are no copies. Of several labels of an id the larger counts;
labels without an id belong to nobody. An empty table gives no rows. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.llm.common import word_list

Weight = tuple[int, ...]


class Diagram:
    """A count-weighted decision diagram over the bits of a mask; equal remainders are one node."""

    def __init__(self, counts: dict[int, Weight], names: str):
        self.order = list(names)
        self.zero = (0,) * len(next(iter(counts.values()), (0,)))
        #: Per level, each node by its two children: number of the node.
        self.nodes: list[dict[tuple[int, int], int]] = [{} for _ in names]
        #: Per level, children and weight of each node; the last level's children are numbers of leaves.
        self.kids: list[list[tuple[int, int]]] = [[] for _ in names]
        self.weights: list[list[Weight]] = [[] for _ in names]
        self.leaves: dict[Weight, int] = {}
        self.leaf_weights: list[Weight] = []
        row = [self._leaf(counts.get(mask, self.zero)) for mask in range(1 << len(names))]
        # The highest bit is the last filter, so neighbours in a row differ in the first one: fold from the last.
        for level in range(len(names) - 1, -1, -1):
            half = len(row) // 2
            row = [self._node(level, row[i], row[i + half]) for i in range(half)]
        self.root = row[0]

    def _leaf(self, weight: Weight) -> int:
        if weight not in self.leaves:
            self.leaves[weight] = len(self.leaf_weights)
            self.leaf_weights.append(weight)
        return self.leaves[weight]

    def weight(self, level: int, node: int) -> Weight:
        return self.leaf_weights[node] if level == len(self.order) else self.weights[level][node]

    def _node(self, level: int, passing: int, failing: int) -> int:
        found = self.nodes[level].get((passing, failing))
        if found is None:
            found = self.nodes[level][passing, failing] = len(self.kids[level])
            self.kids[level].append((passing, failing))
            sides = self.weight(level + 1, passing), self.weight(level + 1, failing)
            self.weights[level].append(tuple(map(sum, zip(*sides, strict=True))))
        return found

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next; only these two levels are rewritten."""
        upper, lower = self.kids[level], self.kids[level + 1]
        weights = self.weights[level]
        self.nodes[level + 1], self.kids[level + 1], self.weights[level + 1] = {}, [], []
        kids = []
        for a, b in upper:
            (pp, pf), (fp, ff) = lower[a], lower[b]
            kids.append((self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)))
        # What lies below a node of the upper level stays the same, so numbers and weights above it stay.
        self.kids[level], self.weights[level] = kids, weights
        self.nodes[level] = {pair: i for i, pair in enumerate(kids)}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Along the path on which all filters pass: filter, what it removes, what is left after it."""
        node = self.root
        for level, name in enumerate(self.order):
            passing, failing = self.kids[level][node]
            yield name, self.weight(level + 1, failing), self.weight(level + 1, passing)
            node = passing


def swaps(n: int) -> Iterator[int]:
    """Levels to swap with their next one so that all orders of ``n`` are met once (Steinhaus, Johnson, Trotter)."""
    if n < 2:
        return
    inner = swaps(n - 1)
    down = True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        turn = next(inner, None)
        if turn is None:
            return
        # The moving filter stands first (after going down) or last.
        yield turn + 1 if down else turn
        down = not down


def audit(counts: dict[int, Weight], names: str) -> list[tuple]:
    """order, step, kept, removed, redundant, unique_fails, lost (one for each further weight), shapley."""
    diagram = Diagram(counts, names)
    found: dict[str, list] = {}

    def read() -> None:
        found["".join(diagram.order)] = list(diagram.steps())

    read()
    for level in swaps(len(names)):
        diagram.swap(level)
        read()
    total, alone = {}, {}
    share = dict.fromkeys(names, 0)
    for steps in found.values():
        for name, removed, _ in steps:
            share[name] += removed[0]
        # First in an order a filter removes all that fail it, last only what fails nothing else.
        total[steps[0][0]] = steps[0][1][0]
        alone[steps[-1][0]] = steps[-1][1][0]
    return [
        (order, i, kept[0], removed[0], total[name] - removed[0], alone[name], *removed[1:], share[name])
        for order, steps in found.items()
        for i, (name, removed, kept) in enumerate(steps, 1)
    ]


def failures(docs: DataFrame, labels: DataFrame, key: Column, part: Column, text: Column, conditions: list[Column],
             flags: list[Column], label_key: Column) -> DataFrame:
    """part, mask, n and a count for each flag: the documents of each part by the conditions they fail.

    ``conditions`` are about one text; the mask's last bit says that a smaller key has the same text. Rows are
    added up by text and key, then by text, before anything is compared, so copies are one row a part and label.
    """
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    whole = F.coalesce(text, F.lit(""))
    rows = docs.select(
        key.alias("key"),
        F.coalesce(part, F.lit("")).alias("part"),
        F.sha2(whole, 256).alias("digest"),
        sum(bits, F.lit(0)).alias("mask"),
    )
    rows = rows.groupBy("key", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = [F.coalesce(f, F.lit(False)).cast("int") for f in flags]
    marked = labels.select(label_key.alias("key"), *[m.alias(f"f{i}") for i, m in enumerate(marks)])
    names = [f"f{i}" for i in range(len(flags))]
    marked = marked.groupBy("key").agg(*[F.max(n).alias(n) for n in names])
    rows = rows.join(marked, "key", "left").fillna(0, names)
    # Of the rows of a text, part and labels: how many, the smallest key, and how many rows have it.
    texts = rows.groupBy("digest", "part", "mask", *names).agg(
        F.sum("n").alias("n"),
        F.min("key").alias("least"),
        F.min_by("n", "key").alias("n_least"),
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("n_keyless"),
    )
    overall = F.min("least").over(Window.partitionBy("digest"))
    first = F.when(F.col("least") == overall, F.col("n_least")).otherwise(0) + F.col("n_keyless")
    split = texts.select("part", "mask", *names, "n", first.alias("n_first"))
    copied = F.col("mask").bitwiseOR(F.lit(1 << len(conditions)))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("n_first").alias("n")),
        F.struct(copied.alias("mask"), (F.col("n") - F.col("n_first")).alias("n")),
    )
    counted = split.select("part", *names, F.inline(both)).where("n > 0")
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(n)).alias(n) for n in names]
    )


def interactions(counted: DataFrame, names: str, lost: list[str]) -> DataFrame:
    """A row for each part, order of the filters ``names`` and step, from the counts of ``failures``.

    A part has at most a row for each mask, which is what one task takes together.
    """
    weights = ["n", *[f"f{i}" for i in range(len(lost))]]
    columns = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]
    schema = pa.schema(
        [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(c, pa.int64()) for c in columns]]
    )

    def run(group: pa.Table) -> pa.Table:
        at = group.to_pydict()
        counts = {m: tuple(at[w][i] for w in weights) for i, m in enumerate(at["mask"])}
        rows = audit(counts, names)
        part = at["part"][0]
        return pa.Table.from_arrays(
            [pa.array([part] * len(rows), pa.string())]
            + [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)],
            schema=schema,
        )

    ddl = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in columns)
    return counted.groupBy("part").applyInArrow(run, ddl)


def text_conditions(text: Column) -> list[Column]:
    """Fixed conditions A to D: few words, few distinct words, many capitals, one of some signs."""
    whole = F.coalesce(text, F.lit(""))
    words = word_list(text)
    n_words = F.size(words)
    capitals = F.length(F.regexp_replace(whole, "[^A-Z]+", ""))
    return [
        n_words < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n_words,
        100 * capitals > 10 * F.length(whole),
        whole.rlike(r"[#$%&*|]"),
    ]
