"""Main text of web pages by structure and by what repeats on a host.

A page is cut into blocks, each with a role: ``main`` (inside an article or main element), ``named``
(inside a container named as content), ``chrome`` (menus, headers, footers, sidebars, notices,
adverts, forms, comments, by element, role or class name) or ``open`` (anything else). The token
streams of a host's pages are then concatenated, a suffix array of their beginnings finds long runs
that occur on distinct pages, and open text that such a run covers is boilerplate. Of a page with
main blocks those are the text, whole, else the named ones; of any other page the open text that is
left, however much the runs cover. Only near-duplicates (a similarity of ``alike`` or more in shingles of five words
with what they repeat) are kept whole: of two copies of a page nothing tells which part is the frame.

A host with more than ``pages_per_set`` pages or ``bytes_per_set`` is dealt into sets by a hash of the page, so that a host
with a third of all pages is many tasks. The suffix array compares the pages of a set; what pages of
different sets have in common is found by codes in two rounds. Each run of ``run_length`` words has
an anchor, the smallest code of its half as long parts, so that equal runs have equal anchors; first
the anchors that several sets have are found, then, of the runs with such an anchor, the run codes
(64 bits, within buckets by further bits) that several sets have. A run is thus boilerplate if any
other page of the host has it, however the pages are dealt.

Null and empty pages have an empty text. A null URL, or one without a host, belongs to a host of its
own, the empty one. Repeated rows are pages like any other and are compared as distinct pages; null
ids as well. An empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import extended, in_files, located
from etalage.llm.url_filter import canonical
from etalage.session import write_through

#: Fixed word lists of the markup language, and of names that mark page furniture.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object select datalist".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
CHROME = set("nav header footer aside form head menu dialog button".split())
MAIN = {"article", "main"}
CONTENT_NAMES = set("article post entry story content main".split())
ROLES = ("open", "named", "main")
CHROME_ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
CHROME_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar"
    " navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice popup modal"
    " overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments"
    " reply replies disqus respond pagination pager toolbar widget".split()
)
#: Parts of a class name that say where or how large a thing is, not what it is.
NEUTRAL_NAMES = set(
    "area article articles bar block body bottom box btn button buttons card cell col column container content desktop element"
    " entry fixed form frame global group home icons inner item items js left link links list local main mini mobile page"
    " panel policy popular post posts primary region right row secondary section sections site skip slot sticky stories"
    " sub tertiary text title top ui unit wrap wrapper zone".split()
)
#: Elements that end by themselves where a block begins.
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


def _says(value: str, names: set[str]) -> bool:
    """Whether a class of the list, whole, is one of the names: ``site-footer`` is, ``social-history`` and
    ``with-sidebar`` are not."""
    for one in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
        parts = [p for p in re.split(r"[^a-z]+", one) if p]
        if not names.isdisjoint(parts) and all(p in names or p in NEUTRAL_NAMES or len(p) == 1 for p in parts):
            return True
    return False


def _attributes(rest: str) -> Iterator[tuple[str, str]]:
    for m in ATTRIBUTE.finditer(rest):
        yield m[1].lower(), m[2] or m[3] or m[4] or ""


def _chrome(name: str, rest: str) -> str:
    """``sure``: page furniture by element, role or being hidden; ``weak``: by a name or as a form, which may also be
    a wrapper around the whole page; else empty."""
    if name in CHROME:
        return "weak" if name == "form" else "sure"
    if not rest or name in ("html", "body", *MAIN):
        return ""
    weak = ""
    for attribute, value in _attributes(rest):
        if attribute == "hidden" or (attribute == "aria-hidden" and value.lower() == "true"):
            return "sure"
        if attribute == "role" and value.lower() in CHROME_ROLES:
            return "sure"
        if attribute == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return "sure"
        # Inline elements are words of a text, whatever they are called.
        if attribute in ("class", "id") and name not in ("h1", "h2") and name not in INLINE and _says(value, CHROME_NAMES):
            weak = "weak"
    return weak


def _is_named(name: str, rest: str) -> bool:
    if not rest or name not in ("div", "section", "td"):
        return False
    return any(
        (attribute == "role" and value.lower() in MAIN) or (attribute in ("class", "id") and _says(value, CONTENT_NAMES))
        for attribute, value in _attributes(rest)
    )


class _Open:
    """An element that is open: its name and what it is."""

    def __init__(self, name: str, chrome: str, main: bool, named: bool):
        self.name, self.chrome, self.main, self.named = name, chrome, main, named


def blocks(page: str) -> list[tuple[str, str]]:
    """Role (main, named or open) and text of every block that is not chrome, in page order.

    References are decoded and white space is one space. A start tag without an end closes with the
    element around it; what is cut off at the end of the page counts up to there. A weak mark of chrome does not count on
    what holds the main elements (where there are none, the named ones): of several, those under the fewest such marks.
    """
    found: list[tuple[str, str, tuple[_Open, ...]]] = []  # role, text, weak marks around it
    holders: dict[str, list[tuple[_Open, ...]]] = {"main": [], "named": []}  # weak marks around the outermost that have a text
    stack: list[_Open] = []
    weak: list[_Open] = []
    outer: dict[str, tuple[_Open, ...] | None] = {"main": None, "named": None}
    sure = main = named = 0
    held: list[str] = []

    def flush() -> None:
        # Decoded as a whole: a reference may stand next to a tag.
        text = " ".join("".join(held).split())
        held.clear()
        if text and not sure:
            role = "main" if main else "named" if named else "open"
            found.append((role, text, tuple(weak)))
            if role != "open" and outer[role] is not None and len(outer[role]) == len(weak):
                holders[role].append(outer[role])

    def push(element: _Open) -> None:
        nonlocal sure, main, named
        stack.append(element)
        sure += element.chrome == "sure"
        if element.chrome == "weak":
            weak.append(element)
        for role, is_one, depth in (("main", element.main, main), ("named", element.named, named)):
            if is_one and not depth:
                outer[role] = tuple(weak)
        main += element.main
        named += element.named

    def pop() -> None:
        nonlocal sure, main, named
        element = stack.pop()
        sure -= element.chrome == "sure"
        if element.chrome == "weak":
            weak.pop()
        main -= element.main
        named -= element.named

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if not sure:
            held.append(html.unescape(page[at : m.start() if m else size]))
        if not m:
            break
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if name in RAW and not m["close"]:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if not m["rest"].endswith("/"):
                at = end.end() if end else size
            continue
        if name not in INLINE:
            flush()
        if m["close"]:
            if name in INLINE:
                # Ends what has begun in the same block only.
                inner = next((i for i, x in enumerate(reversed(stack)) if x.name == name or x.name not in INLINE), len(stack))
                if inner < len(stack) and stack[-1 - inner].name == name:
                    if any(x.chrome for x in stack[len(stack) - 1 - inner :]):
                        flush()
                    for _ in range(inner + 1):
                        pop()
            elif any(name == x.name for x in stack):
                while stack[-1].name != name:
                    pop()
                pop()
            continue
        if name in VOID:
            continue
        if name not in INLINE:
            while stack and (stack[-1].name in INLINE or stack[-1].name in SELF_CLOSING):
                # A paragraph (with inline elements left open in it) ends where the next block begins.
                if stack[-1].name in INLINE and not any(x.name in SELF_CLOSING for x in stack):
                    break
                if stack[-1].name in SELF_CLOSING and stack[-1].name != "p" and stack[-1].name != name:
                    break
                pop()
        chrome = _chrome(name, m["rest"])
        if chrome:
            flush()
        if not m["rest"].endswith("/") or name not in INLINE:
            push(_Open(name, chrome, name in MAIN, not chrome and _is_named(name, m["rest"])))
    flush()
    around = holders["main"] or holders["named"]
    fewest = min(map(len, around), default=0)
    wrappers = {mark for marks in around if len(marks) == fewest for mark in marks}
    return [(role, text) for role, text, marks in found if wrappers.issuperset(marks)]


def repeated(tokens: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """Whether each token lies in a run of ``length`` tokens that a distinct page has as well.

    The suffix array of the concatenated streams by prefix doubling, up to prefixes of ``length``
    tokens (a power of two). A run never passes from one page to the next.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    inside = np.ones(n, bool)  # the run lies within its page
    width = 1
    while width < length:
        if n <= width:
            return np.zeros(n, bool)
        follows = np.full(n, -1, np.int64)
        follows[:-width] = rank[width:]
        inside = np.r_[inside[:-width] & inside[width:] & (page[:-width] == page[width:]), np.zeros(width, bool)]
        rank = np.unique(rank * (n + 1) + follows + 1, return_inverse=True)[1].astype(np.int64)
        width *= 2
    starts = np.flatnonzero(inside)
    suffixes = starts[np.lexsort((page[starts], rank[starts]))]
    if not len(suffixes):
        return np.zeros(n, bool)
    ranks, pages = rank[suffixes], page[suffixes]
    begins = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
    ends = np.r_[begins[1:], len(ranks)] - 1
    on_two = pages[begins] != pages[ends]  # sorted by page within a rank
    found = suffixes[np.repeat(on_two, ends - begins + 1)]
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, found, 1)
    np.add.at(marks, found + length, -1)
    return np.cumsum(marks)[:-1] > 0


def mixed(codes: np.ndarray) -> np.ndarray:
    """Codes with their bits mixed, one to one."""
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return codes ^ (codes >> np.uint64(32))


def word_code(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def runs(tokens: np.ndarray, page: np.ndarray, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, anchor and code of every run of ``length`` tokens (an even number) within a page.

    ``codes`` has the code of each token's word. Both are the same for equal runs wherever they are.
    """
    n, half = len(tokens) - length + 1, length // 2
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    own = codes[tokens]
    parts = np.zeros(len(tokens) - half + 1, np.uint64)
    for i in range(half):
        parts = parts * np.uint64(0xD6E8FEB86659FD93) + own[i : i + len(parts)]
    parts = mixed(parts)
    anchor = parts[:n].copy()
    for i in range(1, length - half + 1):
        np.minimum(anchor, parts[i : i + n], out=anchor)
    code = mixed(parts[:n] * np.uint64(0x2545F4914F6CDD1D) + parts[half : half + n])
    begin = np.flatnonzero(page[:n] == page[length - 1 :])
    return begin, anchor[begin], code[begin]


def is_copy(covered: np.ndarray, alike: float, shingle: int = 5) -> bool:
    """Whether a page of which this much is repeated is a near-duplicate of what it is repeated from: the similarity
    of their shingles, were the other page as long and had nothing else in common with it."""
    n = max(len(covered) - shingle + 1, 1)
    shared = np.convolve(covered, np.ones(shingle, np.int64))[shingle - 1 : len(covered)] == shingle if len(covered) >= shingle else covered[:0]
    s = int(shared.sum())
    return s > 0 and s >= alike * (2 * n - s)


def in_buckets(codes: np.ndarray, buckets: int, kind: type) -> tuple[list[int], list[bytes]]:
    """The distinct codes dealt to buckets; of each the bytes of as many low bits as ``kind`` has."""
    codes = np.unique(codes)
    bucket = (mixed(codes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, begins = np.unique(bucket[order], return_index=True)
    return found.tolist(), [x.astype(kind).tobytes() for x in np.split(codes[order], begins[1:])] if len(found) else []


def on_several(table: pa.Table, kind: type) -> pa.Table:
    """Of each row's codes those that another row has as well; rows are the sets of a host, for one bucket."""
    own = [np.unique(np.frombuffer(c, kind)) for c in table.column("codes").to_pylist()]
    codes, times = np.unique(np.concatenate(own), return_counts=True)
    both = codes[times > 1]
    shared = [c[np.isin(c, both)] for c in own]
    some = [i for i, c in enumerate(shared) if len(c)]
    found = table.select(["host", "set", "bucket"]).take(pa.array(some, pa.int64()))
    return found.append_column("codes", pa.array([shared[i].tobytes() for i in some], pa.binary()))


def extract(
    pages: DataFrame,
    keep: list[str],
    page: str = "html",
    url: str = "url",
    run_length: int = 16,
    pages_per_set: int = 512,
    bytes_per_set: int = 16 << 20,
    alike: float = 0.8,
) -> DataFrame:
    """The columns ``keep``, ``text`` and ``repeated_words`` (words of the page's blocks that lie in
    repeated runs, whether or not they count as text)."""
    host, _ = canonical(F.col(f"`{url}`"))
    own = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)]
    # Dealt by the page and its place, so that copies of one page are spread as well.
    file = F.substring_index("_loc.file", "/", -1)
    rows = located(
        in_files(pages),
        [
            F.struct(*own).alias("kept"),
            F.col(f"`{url}`").alias("url"),
            host.alias("host"),
            F.col(f"`{page}`").alias("html"),
        ],
    )
    rows = rows.select("kept", "host", F.xxhash64("url", "html", file, "_loc.row").alias("dealt"), "html")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [blocks(p or "") for p in part.column(3).to_pylist()]
                role = pa.array([[ROLES.index(r) for r, _ in x] for x in found], pa.list_(pa.int32()))
                texts = pa.array([[t for _, t in x] for x in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], role, texts], names=["kept", "host", "dealt", "roles", "blocks"]
                )

    cut_up = rows.mapInArrow(cut, extended(rows.drop("html").schema, "roles array<int>, blocks array<string>"))
    # Only hosts with more than one set are looked up; the pages move once, by host and set: the rounds
    # below read one shuffle. For that, its rows must have the same columns and conditions in each.
    # A set is bounded in pages and in bytes; only a single page can be larger.
    size = F.coalesce(F.octet_length(F.col(f"`{page}`")), F.lit(0)).cast("long")
    sets = F.greatest(F.ceil(F.count("*") / pages_per_set), F.ceil(F.sum("size") / bytes_per_set))
    counted = pages.select(host.alias("host"), size.alias("size")).groupBy("host").agg(sets.alias("sets"))
    large = write_through(counted.where("sets > 1"), "large-hosts")
    dealt = cut_up.join(large, "host", "left").withColumn("sets", F.expr("coalesce(sets, 1)"))
    grouped = dealt.withColumn("set", F.expr("pmod(dealt, sets)")).repartition("host", "set")
    by_set = grouped.groupBy("host", "set")

    def numbered(table: pa.Table) -> tuple[list[list[list[str]]], np.ndarray, np.ndarray, dict[str, int]]:
        words = [[b.split(" ") for b in x] for x in table.column("blocks").to_pylist()]
        sizes = np.array([sum(map(len, x)) for x in words], np.int64)
        number: dict[str, int] = {}
        stream = np.array([number.setdefault(w, len(number)) for x in words for b in x for w in b], np.int64)
        return words, stream, np.repeat(np.arange(len(words)), sizes), number

    def runs_of(stream: np.ndarray, page: np.ndarray, number: dict[str, int]):
        return runs(stream, page, np.array([word_code(w) for w in number], np.uint64), run_length)

    def sent(table: pa.Table, codes: np.ndarray, kind: type) -> pa.Table:
        # A bucket has the codes of some 16 sets, however large the host.
        bucket, packed = in_buckets(codes, max(16, -(-table["sets"][0].as_py() // 16)), kind)
        named = [pa.array([table[c][0].as_py()] * len(bucket), table[c].type) for c in ("host", "set")]
        return pa.table([*named, pa.array(bucket, pa.int64()), pa.array(packed, pa.binary())], names=["host", "set", "bucket", "codes"])

    def several(table: pa.Table) -> bool:
        return len(table) > 0 and table["sets"][0].as_py() > 1

    def anchors(table: pa.Table) -> pa.Table:
        if not several(table):
            return pa.table({"host": [], "set": [], "bucket": [], "codes": []}, schema=packed_schema)
        return sent(table, runs_of(*numbered(table)[1:])[1], np.uint32)

    def likely(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not several(table) or not len(shared):
            return pa.table({"host": [], "set": [], "bucket": [], "codes": []}, schema=packed_schema)
        _, anchor, code = runs_of(*numbered(table)[1:])
        both = np.frombuffer(b"".join(shared["codes"].to_pylist()), np.uint32)
        return sent(table, code[np.isin(anchor.astype(np.uint32), both)], np.uint64)

    packed_schema = pa.schema([("host", pa.string()), ("set", pa.int64()), ("bucket", pa.int64()), ("codes", pa.binary())])
    packed = "host string, set long, bucket long, codes binary"

    def on_sets(df: DataFrame, kind: type) -> DataFrame:
        return df.groupBy("host", "bucket").applyInArrow(lambda t: on_several(t, kind), packed).groupBy("host", "set")

    shared_anchors = on_sets(by_set.applyInArrow(anchors, packed), np.uint32)
    shared_runs = on_sets(by_set.cogroup(shared_anchors).applyInArrow(likely, packed), np.uint64)

    def compare(table: pa.Table, shared: pa.Table) -> pa.Table:
        roles, texts = table.column("roles").to_pylist(), table.column("blocks").to_pylist()
        words, stream, page, number = numbered(table)
        sizes = np.bincount(page, minlength=len(words))
        covered = repeated(stream, page, run_length)
        if len(shared):
            begin, _, code = runs_of(stream, page, number)
            found = begin[np.isin(code, np.frombuffer(b"".join(shared["codes"].to_pylist()), np.uint64))]
            marks = np.zeros(len(stream) + 1, np.int64)
            np.add.at(marks, found, 1)
            np.add.at(marks, found + run_length, -1)
            covered = covered | (np.cumsum(marks)[:-1] > 0)
        out, counts, at = [], [], 0
        for role, text, split, size in zip(roles, texts, words, sizes.tolist(), strict=True):
            own = covered[at : at + size]
            at += size
            counts.append(int(own.sum()))
            best = max(role, default=0)
            if best or is_copy(own, alike):
                out.append(" ".join(t for t, r in zip(text, role, strict=True) if r == best))
            else:
                flat = [w for b in split for w in b]
                out.append(" ".join(w for w, c in zip(flat, own.tolist(), strict=True) if not c))
        found = {"text": pa.array(out, pa.string()), "repeated_words": pa.array(counts, pa.int64())}
        return pa.table({"kept": table.column("kept"), **found})

    schema = extended(grouped.select("kept").schema, "text string, repeated_words long")
    done = by_set.cogroup(shared_runs).applyInArrow(compare, schema)
    return done.select(*[F.col(f"kept._{i}").alias(c) for i, c in enumerate(keep)], "text", "repeated_words")
