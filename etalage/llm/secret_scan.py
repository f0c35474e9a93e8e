"""Secret scan: candidates by shape, false positives removed by a random forest.

Runs of 16 or more letters, digits and key characters are candidates, and any value of 8 or more characters that is
given to a name of a secret, whole. Each gets features: its length, its transitions between kinds of characters, how much of it common words cover, its path,
and the words beside it. A forest trained from labelled findings tells secrets from the rest.

Null and empty texts have no candidate; a null path has no path features. Repeated rows and null ids
give their candidates again. Texts are read whole. Where the labelled findings lack one of the two
classes there is nothing to learn, and every candidate is kept with a score of 1. An empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import word_list
from etalage.session import write_through

#: Fixed patterns: a candidate (with the padding that may end it), what lies between quotes, brackets and signs of
#: assignment, names of secrets, words of placeholders, paths of tests and examples.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
VALUE = r"[^\s\"'`,;()\[\]{}<>=:]{8,}(?:={1,2}(?![^\s\"'`,;()\[\]{}<>]))?"
NAMES = r"(?i)token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|credential|auth|bearer"
PLACEHOLDERS = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|test|fake|1234567"
TEST_PATHS = r"(?i)test|example|sample|fixture|mock|docs?/"

#: A name of a secret to which what follows is given.
GIVEN = NAMES.replace("(?i)", "(?i)(?:") + r")[A-Za-z0-9_.-]*[\"'`]?\]?\s*(?:=>|:=|[=:])\s*[\"'`]?$"

SHAPE = ["length", "transitions", "vowel_changes", "digits", "capitals", "different", "hex_only", "covered"]
PATH = ["path_depth", "path_test"]
NEIGHBOURS = ["named", "assigned", "quoted", "placeholder", "words_before"]
FEATURES = [*SHAPE, *PATH, *NEIGHBOURS]


def _places(word: Column, pattern: str) -> Column:
    """The matches of a pattern in a word, each with its own place (from 1), also where a value is there twice."""
    begin = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<value:string,at:int>>").alias("out"))

    def move(acc: Column, value: Column) -> Column:
        at = F.call_function("locate", value, word, acc["next"])
        found = F.array(F.struct(value.alias("value"), at.alias("at")))
        return F.struct((at + F.length(value)).alias("next"), F.concat(acc["out"], found).alias("out"))

    return F.aggregate(F.regexp_extract_all(word, F.lit(pattern), F.lit(0)), begin, move, lambda acc: acc["out"])


def candidates(docs: DataFrame, keep: dict[str, Column], path: Column, text: str = "text") -> DataFrame:
    """A row for each candidate: the columns ``keep``, path, word_no (from 0), value, and the text before and after
    it (two words and one, and the rest of its own word)."""
    own = F.struct(*[c.alias(n) for n, c in keep.items()]).alias("_kept")
    rows = docs.select(own, path.cast("string").alias("path"), word_list(F.col(f"`{text}`")).alias("_words"))
    ends = r"[=:][\"'`]?$"

    def spot(w: Column, i: Column) -> Column:
        long_one = (F.length(w) >= 16) & w.rlike(CANDIDATE)
        given = (F.length(w) >= 8) & (w.rlike("[=:]") | F.coalesce((i > 0) & F.get("_words", i - 1).rlike(ends), F.lit(False)))
        return F.when(long_one | given, i)

    spots = F.filter(F.transform("_words", spot), lambda i: i.isNotNull())
    near = F.transform(
        spots,
        lambda i: F.struct(
            i.alias("word_no"),
            F.get("_words", i).alias("word"),
            F.concat_ws(" ", F.when(i > 1, F.get("_words", i - 2)), F.when(i > 0, F.get("_words", i - 1))).alias("left"),
            F.coalesce(F.get("_words", i + 1), F.lit("")).alias("right"),
        ),
    )
    spotted = rows.select("_kept", "path", F.explode(near).alias("s")).select("_kept", "path", "s.*")

    def before(at: Column) -> Column:
        return F.concat("left", F.lit(" "), F.substring("word", F.lit(1), at - 1))

    parts = spotted.withColumn("part", F.explode(_places(F.col("word"), VALUE)))
    # What is given to a name is a candidate whole; of anything else its long runs are.
    runs = F.transform(
        _places(F.col("part.value"), CANDIDATE),
        lambda x: F.struct(x["value"].alias("value"), (x["at"] + F.col("part.at") - 1).alias("at")),
    )
    chosen = F.when(before(F.col("part.at")).rlike(GIVEN), F.array(F.col("part"))).otherwise(runs)
    values = parts.withColumn("found", F.explode(chosen)).withColumns({"value": F.col("found.value"), "_at": F.col("found.at")})
    return values.select(
        "_kept.*",
        "path",
        "word_no",
        "value",
        before(F.col("_at")).alias("before"),
        F.concat(F.substring("word", F.col("_at") + F.length("value"), F.length("word")), F.lit(" "), "right").alias("after"),
    )


def common_words(docs: DataFrame, text: str = "text", most: int = 300) -> list[str]:
    """The ``most`` most frequent words of 3 to 6 letters a-z, counted over all texts; ties in text order."""
    words = F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit(r"\b[a-z]{3,6}\b"), F.lit(0))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").count()
    return [r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(most).collect()]


def with_features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """``found`` with the feature columns; ``dictionary`` is a short list of plain words."""
    value, before = F.col("value"), F.col("before")
    length = F.length(value).cast("double")

    def share_without(pattern: str, replaced: Column = value) -> Column:
        return 1 - F.length(F.regexp_replace(replaced, pattern, "")) / length

    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "0")
    sounds = F.regexp_replace(F.regexp_replace(F.lower(value), "[aeiouy]+", "1"), "[b-df-hj-np-tv-xz]+", "2")
    plain = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return found.select(
        "*",
        length.alias("length"),
        (F.length(kinds) / length).alias("transitions"),
        (F.length(sounds) / length).alias("vowel_changes"),
        share_without("[0-9]").alias("digits"),
        share_without("[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split(value, ""))) / length).alias("different"),
        number(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex_only"),
        (share_without(plain, F.lower(value)) if plain else F.lit(0.0)).alias("covered"),
        number(F.size(F.split("path", "/"))).alias("path_depth"),
        number(F.col("path").rlike(TEST_PATHS)).alias("path_test"),
        number(before.rlike(NAMES)).alias("named"),
        number(before.rlike(r"[=:]\s*[\"'`]?$")).alias("assigned"),
        number(before.rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")).alias("quoted"),
        number(F.concat_ws(" ", "before", "value").rlike(PLACEHOLDERS)).alias("placeholder"),
        number(F.size(F.regexp_extract_all("before", F.lit(r"(?:^|\s)[a-z]+(?=\s|$)"), F.lit(0)))).alias("words_before"),
    )


def label_by_rule(found: DataFrame) -> DataFrame:
    """Labelled findings where none are given: the clear cases of ``found``, as column label; others are null.

    Secret: a quoted value given to a name of a secret, with digits and no placeholder. Not a secret:
    letters only or digits only, or a placeholder, outside such an assignment; in one, a plain word in lower case.
    """
    given = (F.col("named") == 1) & (F.col("assigned") == 1)
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1)
    yes = given & (F.col("quoted") == 1) & mixed & (F.col("placeholder") == 0)
    word = F.col("value").rlike("^[a-z]+$")
    no = (~given & (~mixed | (F.col("placeholder") == 1))) | (given & word)
    return found.withColumn("label", F.when(yes, 1.0).when(no, 0.0))


def train(
    labelled: DataFrame, per_class: int = 10_000, trees: int = 24, seed: int = 11
) -> RandomForestClassificationModel | None:
    """A forest from at most ``per_class`` labelled findings of each class, drawn by a hash of their value.

    Of every other finding (by hash) the neighbouring words are blanked, so that the forest has to
    know secrets by their shape as well, not only by the words the labels may rest on.
    """
    drawn = F.xxhash64("value", "before")
    parts = [
        labelled.where(F.col("label") == c).select("label", *FEATURES, drawn.alias("_drawn")).orderBy("_drawn").limit(per_class)
        for c in (0.0, 1.0)
    ]
    rows = write_through(parts[0].unionAll(parts[1]), "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    blank = F.pmod(F.col("_drawn"), F.lit(2)) == 0
    rows = rows.select("label", *SHAPE, *PATH, *[F.when(blank, 0.0).otherwise(F.col(c)).alias(c) for c in NEIGHBOURS])
    forest = RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=trees, maxDepth=7, seed=seed)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows))


def classify(found: DataFrame, model: RandomForestClassificationModel | None, least: float = 0.5) -> DataFrame:
    """``found`` (with features) with score and is_secret."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(found)
    scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*found.columns, "score", (F.col("score") >= least).alias("is_secret"))


def scan(
    docs: DataFrame, keep: dict[str, Column], path: Column, text: str = "text", labelled: DataFrame | None = None
) -> DataFrame:
    """Candidates of all documents with features, score and is_secret.

    The forest learns from ``labelled`` (value, and label 1 or 0: findings that have been judged), and where there is none
    from the clear cases. A value that is labelled both ways counts as a secret.
    """
    dictionary = common_words(docs, text)
    found = write_through(with_features(candidates(docs, keep, path, text), dictionary), "candidates")
    if labelled is None:
        return classify(found, train(label_by_rule(found)))
    known = labelled.groupBy(F.col("value").alias("value")).agg(F.max("label").cast("double").alias("label"))
    return classify(found, train(found.join(known, "value")))
