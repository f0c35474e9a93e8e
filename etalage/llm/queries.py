"""The registered queries of this folder, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.llm import (
    bpe,
    collocations,
    exact_dedup,
    filter_audit,
    html_extract,
    license_scan,
    mixing,
    quality,
    secret_scan,
    simhash,
    toxicity,
    url_filter,
    vector_search,
)
from etalage.llm.common import ready, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Where the vocabulary lies, and the pattern that goes with it.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(ready(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_exact_dedup",
    """
        WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        grouped AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM hashed JOIN grouped USING (t)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return found.select(
        F.col("key").alias("doc_id"),
        F.col("keeper.key").alias("keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        F.col("digest").alias("text_sha256"),
    )


#: The sources' weights in turn, and how many times its size a source may give.
MIX_WEIGHTS, MIX_MOST = [5, 2, 1], 3
#: Over the training a source grows rarer, stays as it is, or comes more and more, in turn.
MIX_SHAPES = [[(0.0, 1.5), (1.0, 0.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)]]


def mixed(docs: DataFrame, key: Column) -> DataFrame:
    return mixing.mix(docs, key, F.col("source"), word_count(F.col("text")), MIX_WEIGHTS, MIX_SHAPES, MIX_MOST)


MIX_SQL = r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
    ), sources AS (
        SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM sources
    ), levels AS (
        SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS nth, CAST((SELECT sum(source_size) FROM weighed)
                - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
        FROM weighed
    ), chosen AS (
        SELECT coalesce(arg_min(level, nth) FILTER (level * weight <= cap), 0) AS level FROM levels
    ), targets AS (
        SELECT source, source_size, rank, least(CAST(cap AS DOUBLE), chosen.level * weight) AS target FROM weighed, chosen
    ), tapes AS (
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, (t.rank - 1) % 3 AS shape,
            coalesce(sum(size) OVER (
                PARTITION BY s.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), size, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    ), taken AS (
        SELECT *, CASE WHEN size > 0 THEN
            CAST(CAST(2 * start + size AS DOUBLE) <= 2 * target AS BIGINT)
            + CAST(CAST(2 * start + 2 * source_size + size AS DOUBLE) <= 2 * target AS BIGINT)
            + CAST(CAST(2 * start + 4 * source_size + size AS DOUBLE) <= 2 * target AS BIGINT) ELSE 0 END AS copies
        FROM tapes
    )
"""


def time_sql(share: str) -> str:
    """The inverse of each shape's integral in SQL, in the operator's own steps."""
    arms = []
    for i, shape in enumerate(MIX_SHAPES):
        whole = sum((d0 + d1) / 2 * (t1 - t0) for (t0, d0), (t1, d1) in zip(shape, shape[1:], strict=False))
        cases, passed = [], 0.0
        for (t0, d0), (t1, d1) in zip(shape, shape[1:], strict=False):
            before, passed = passed, passed + (d0 + d1) / 2 * (t1 - t0)
            rest = f"({share} * {whole!r}::DOUBLE - {before!r}::DOUBLE)"
            root = f"sqrt(greatest({d0 * d0!r}::DOUBLE + {2 * ((d1 - d0) / (t1 - t0))!r}::DOUBLE * {rest}, 0::DOUBLE))"
            time = f"{t0!r}::DOUBLE + coalesce(2::DOUBLE * {rest} / nullif({d0!r}::DOUBLE + {root}, 0), 0::DOUBLE)"
            cases.append(f"WHEN {share} * {whole!r}::DOUBLE < {passed!r}::DOUBLE THEN {time}")
        arms.append(f"WHEN {i} THEN CASE {' '.join(cases)} ELSE 1::DOUBLE END")
    return f"CASE shape {' '.join(arms)} END"


_SHARE = "(CAST(start + source_size * turn AS DOUBLE) / nullif(target, 0))"


@query(
    "op3_source_mix",
    MIX_SQL
    + f"""
    SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
        CASE WHEN copies > 0 THEN {time_sql(_SHARE)} END AS position
    FROM (SELECT *, 0 AS turn FROM taken)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the training position of its first copy, range-sorted by it; those not taken come last."""
    found = mixed(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return found.orderBy(F.col("position").asc_nulls_last(), "key", "start").select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
        "position",
    )


@query(
    "op3_source_mix_order",
    MIX_SQL
    + f"""
    SELECT doc_id, turn, size, {time_sql(_SHARE)} AS position
    FROM (SELECT *, CAST(unnest(range(0, copies)) AS INT) AS turn FROM taken WHERE copies > 0)
    """,
)
def op3_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of the mix with its training position, in the order of training."""
    found = mixed(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return mixing.in_order(found, MIX_SHAPES).select(F.col("key").alias("doc_id"), "turn", "size", "position")


def quality_sql(least_rows: int = 200, reach: float = 5.0) -> str:
    """Exact quartiles: what the sketches give as long as a group has no more rows than a sketch holds."""
    ratios = {n: f"CAST({a} AS DOUBLE) / nullif({b}, 0)" for n, (a, b, _, _) in quality.RATIOS.items()}
    levels = {"own": "lang, source", "lang": "lang", "overall": "1"}
    quartiles = ", ".join(
        f"quantile_disc({r}, {q}) OVER (PARTITION BY {by}) AS {level}_{n}_{i}"
        for n, r in ratios.items()
        for level, by in levels.items()
        for i, q in ((1, 0.25), (3, 0.75))
    )

    def chosen(n: str, i: int) -> str:
        own, lang = (f"WHEN {x}_n >= {least_rows} THEN {x}_{n}_{i}" for x in ("own", "lang"))
        return f"CASE {own} {lang} ELSE overall_{n}_{i} END"

    picked = ", ".join(f"any_value({chosen(n, i)}) AS {n}_{i}" for n in ratios for i in (1, 3))
    bad = []
    for n, (_, _, side, least) in quality.RATIOS.items():
        width = f"greatest({n}_3 - {n}_1, {least}) * {reach}"
        bad.append(f"coalesce({ratios[n]} > {n}_3 + {width}, FALSE)")
        if side == "both":
            bad.append(f"coalesce({ratios[n]} < {n}_1 - {width}, FALSE)")
    return f"""
        WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
        split AS (
            SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
                list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM texts
        ), windows AS (
            SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM split)
        ), twice AS (
            SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS c FROM windows) WHERE c > 1
        ), covered AS (
            SELECT rid, sum(least(8, coalesce(following - i, 8))) AS n
            FROM (SELECT *, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM twice) GROUP BY rid
        ), counts AS (
            SELECT doc_id, lang, source, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_capitals,
                len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes,
                len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
            FROM split LEFT JOIN covered USING (rid)
        ), based AS (
            SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM counts
        ), ranked AS (
            SELECT *, count(*) OVER (PARTITION BY lang, source) AS own_n, count(*) OVER (PARTITION BY lang) AS lang_n, {quartiles}
            FROM based WHERE NOT base_failed
        ), limits AS (SELECT lang, source, {picked} FROM ranked GROUP BY lang, source)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept
        FROM based b LEFT JOIN limits l ON b.lang IS NOT DISTINCT FROM l.lang AND b.source IS NOT DISTINCT FROM l.source
    """


@query("op4_quality_rules", quality_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept")


#: Fixed rules: verdict, host, start of the path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Words in a host name that block it where no rule fits: gambling, adult content, pills, dubious loans and goods,
#: tracking and adverts, spam, cracked software. A list of one's own goes to ``url_rules``.
HOST_WORDS = (
    "casino poker- roulette jackpot free-bets betting- adult- xxx- porn escort- viagra cialis cheap-pills payday-loan"
    " replica-watch ads-track adserver popunder clickbank- spam- linkfarm warez keygen torrent-"
).split()


def url_rules(words: list[str] = HOST_WORDS) -> list[url_filter.Rule]:
    return [
        *[url_filter.prefix_rule(*r) for r in URL_RULES],
        *[url_filter.Rule(f"*{w}**", "block", None, 1) for w in words],
    ]


def url_sql() -> str:
    fits = " ".join(
        f"WHEN ('.' || host) LIKE '%.{h}' AND starts_with(path, '{p}') THEN '{h}{p}'"
        for _, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    verdicts = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in URL_RULES)
    words = " OR ".join(f"contains(host, '{w}')" for w in HOST_WORDS)
    return f"""
        WITH rest AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
        ), ruled AS (
            SELECT *, CASE {fits} END AS rule FROM parts
        )
        SELECT page_id, host, path, rule, CASE {verdicts} WHEN {words} THEN 'block' ELSE 'allow' END AS verdict FROM ruled
    """


@query("op5_url_filter", url_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_rules(), keep=["page_id"])


def bpe_digests(docs: DataFrame, keep: str = "doc_id") -> DataFrame:
    encoded = bpe.encode(docs, RANKS, PATTERN, keep=[keep])
    return bpe.decode(encoded, RANKS).select(
        keep,
        F.size("ids").cast("bigint").alias("n_tokens"),
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return found.select(
        F.col("key").alias("doc_id"),
        simhash.as_hex(F.col("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, labels.where(~held))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("offending").cast("bigint").alias("n_offending"),
    )


@query("op8_html_extract")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "repeated_words")


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, {"doc_id": F.col("doc_id")}, F.col("source"))
    # The value itself is not passed on.
    return found.select(
        "doc_id",
        "word_no",
        F.sha2("value", 256).alias("value_sha256"),
        F.length("value").alias("n_chars"),
        "score",
        "is_secret",
    )


#: Fixed: the filters' letters, in the order of the mask's bits; the last is the repeated text.
FILTERS = "ABCDE"


@query(
    "op13_filter_audit",
    r"""
        WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
        lost AS (
            SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
        ), failing AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
                CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS s
            FROM split LEFT JOIN lost USING (doc_id)
        ), masks AS (
            SELECT part, s, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, s
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT concat(a.x, b.x, c.x, d.x, e.x) AS o FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), told AS (
            SELECT part, o, k, n, good, toxic, s, contains(s, o[k]) AS fails,
                length(translate(left(o, k - 1), s, '')) < k - 1 AS gone
            FROM masks, orders, (SELECT unnest(range(1, 6)) AS k)
        ), steps AS (
            SELECT part, o, CAST(k AS INT) AS step, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
                coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed, coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
                coalesce(sum(n) FILTER (s = o[k]), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
                coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
            FROM told GROUP BY part, o, k
        )
        SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
            CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
            CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
        FROM steps
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    text, key = F.col("text"), F.col("doc_id")
    flags = [F.col("quality") == 1, F.col("toxic") == 1]
    counted = filter_audit.failures(docs, labels, key, F.col("lang"), text, filter_audit.text_conditions(text), flags, key)
    return filter_audit.interactions(counted, FILTERS, ["good_lost", "toxic_lost"])


@query(
    "op11_collocations",
    r"""
        WITH texts AS (
            SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        ), pieces AS (
            SELECT d, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts
        ), words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k))
            GROUP BY ALL HAVING count(*) >= 10
        ), whole AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE k > 1),
        cuts AS (
            SELECT *, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS c FROM whole)
        ), scored AS (
            SELECT q.lang, q.phrase, q.k, q.f AS a, h.f AS l, t.f AS r, c,
                1000000 * CAST(q.f AS HUGEINT) * q.f // (CAST(h.f AS HUGEINT) * t.f) AS score
            FROM cuts q JOIN grams h ON h.lang = q.lang AND h.phrase = q.head AND h.k = q.c
            JOIN grams t ON t.lang = q.lang AND t.phrase = q.tail AND t.k = q.k - q.c
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, c) = 1
        ), around AS (
            SELECT lang, inner_phrase, max(f) AS f FROM (
                SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inner_phrase FROM whole WHERE k = 3)
            GROUP BY ALL
        ), kept AS (
            SELECT s.* FROM lowest s LEFT JOIN around u ON u.lang = s.lang AND u.inner_phrase = s.phrase AND s.k = 2
            WHERE u.f IS NULL OR 100 * u.f < 50 * s.a
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), F.col("lang"), F.col("text"))


@query("op12_vector_search")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = vector_search.nearest(vectors, F.col("vec_id"), F.col("embedding"), F.col("key") % 50 == 0)
    return found.select(
        F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score"
    )
