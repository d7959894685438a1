"""Secret scan: candidates by shape, false positives removed by a random forest.

Only DataFrame expressions and Spark's own forest run here. Blank-delimited words are cut at
quotes, brackets, commas, semicolons, ampersands and after ``name=`` or ``name:``, so that
one line of JSON or a query string gives all its values. A candidate is a piece of at least
``SHORTEST`` characters that holds a digit or changes case inside, or a piece of at least
``ASSIGNED_SHORTEST`` characters right behind a password-like name and a sign, in the same
word or in the words before. A value that itself holds such a mark is met in part. Its features are its length, shares of
character classes, class and vowel changes along it, distinct characters, how far words of
the corpus cover it, whether it looks like a path, URL, address or number, and what stands
before and after it.

Labelled findings come from the fixed rules below: formats that only a secret or only a
harmless string has. The forest learns from at most ``TRAIN_ROWS`` of either label and then
judges every candidate, labelled or not. The word list for coverage has the ``DICTIONARY``
words that most documents hold, counted over all documents; it is the only broadcast.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table, text_rows

SHORTEST, ASSIGNED_SHORTEST = 14, 6
DICTIONARY = 4096
TRAIN_ROWS = 20_000
TREES, DEPTH = 40, 8
THRESHOLD = 0.5
# Names of secrets, harmless names, formats of providers' keys, harmless formats.
NAMES = "passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth"
DUMMY = "example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test[_-]?key|0123456789|1234567890"
KEYS = r"^(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})$"
ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
NUMBER = r"^[+(]?[0-9][0-9 ().,:/-]*$"
PLACE = r"^(?:[a-z]+://|www\.|/|\./|[A-Za-z]:[\\/]|[A-Za-z0-9_-]+(?:/[A-Za-z0-9_.-]+){2,}$)"
_ASSIGNED = rf"(?i)(?:{NAMES})[\"']?\s*[=:]+\s*$"
_INSIDE = rf"(?i)(?:{NAMES})[\"']?[=:]."
_SHAPE = "[0-9]|[a-z][A-Z]|[A-Z]{2}.*[a-z]|A[KS]IA[A-Z]{16}"
_CUTS = r"[\"'`,;&<>(){}\[\]]+|(?<=[A-Za-z_-][=:])(?![/=:]|$)"
_CLASS_CHANGE = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^a-zA-Z0-9])(?=[a-zA-Z0-9])"
_VOWEL_CHANGE = r"(?i)(?<=[aeiouy])(?=[b-df-hj-np-tv-xz])|(?<=[b-df-hj-np-tv-xz])(?=[aeiouy])"
FEATURES = ["f_length", "f_digit", "f_upper", "f_lower", "f_other", "f_hex", "f_class", "f_vowel", "f_distinct", "f_covered", "f_place", "f_address", "f_number", "f_dummy", "f_assigned", "f_named", "f_quoted", "f_before", "f_after"]


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, word_at, piece_at, value, lead, before, after, quoted``: candidates and what surrounds them.

    ``word_at`` counts blank-delimited words from 0, ``piece_at`` the pieces of a word; ``lead``
    is what stands before the value: the two pieces before it, or the two words before its word.
    A word travels once, not once per candidate, so a text without blanks stays linear.
    """
    # Split at ASCII blanks only, so that one word never spans a line.
    words = text_rows(docs).filter("text <> ''").select("doc_id", F.split("text", r"[ \t\n\r\f\x0B]+").alias("w"))
    word = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    behind = lambda i: word(i - 1).rlike("[=:]$") & F.concat_ws(" ", word(i - 2), word(i - 1)).rlike(_ASSIGNED)
    likely = lambda x, i: ((F.length(x) >= SHORTEST) & x.rlike(_SHAPE)) | ((F.length(x) >= ASSIGNED_SHORTEST) & (x.rlike(_INSIDE) | behind(i)))
    # The neighbours go along, so that no candidate carries the words of its document.
    kept = F.transform("w", lambda x, i: F.when(likely(x, i), F.struct(i.alias("word_at"), x.alias("word"), word(i - 2).alias("before2"), word(i - 1).alias("before"), word(i + 1).alias("after"))))
    found = words.select("doc_id", F.explode(F.array_compact(kept)).alias("c")).select("doc_id", "c.*")
    cut = found.withColumns({"p": F.split("word", _CUTS), "quoted": F.col("word").rlike("[\"'].*[\"']")}).drop("word")
    part = lambda j: F.coalesce(F.get("p", j), F.lit(""))

    def piece(x: Column, j: Column) -> Column:
        # End marks are no part of a value; what stands before it names it.
        value = F.regexp_extract(x, r"^(.*?)[^A-Za-z0-9+/=_-]*$", 1)
        own = F.when(j > 0, F.concat(F.when(j > 1, part(j - 2)).otherwise(""), part(j - 1))).otherwise("")
        lead = F.when(own != "", own).otherwise(F.concat_ws(" ", "before2", "before"))
        # A name with its own sign is the next value's name.
        keep = ~value.rlike(rf"(?i)(?:{NAMES})=+$") & (((F.length(value) >= SHORTEST) & value.rlike(_SHAPE)) | ((F.length(value) >= ASSIGNED_SHORTEST) & lead.rlike(_ASSIGNED)))
        return F.when(keep, F.struct(j.alias("piece_at"), value.alias("value"), lead.alias("lead")))

    return cut.select("doc_id", "word_at", "before", "after", "quoted", F.explode(F.array_compact(F.transform("p", piece))).alias("v")).select(
        "doc_id", "word_at", "v.piece_at", "v.value", "v.lead", "before", "after", "quoted"
    )


def common_words(docs: DataFrame, most: int = DICTIONARY) -> DataFrame:
    """The ``most`` lower-case words of 4 to 12 letters that most documents hold."""
    words = text_rows(docs).select(F.explode(F.array_distinct(F.split("text", r"[ \t\n\r\f\x0B]+"))).alias("piece")).filter("length(piece) between 4 and 12 and piece rlike '^[a-z]+$'")
    return words.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "piece").limit(most).select("piece")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", pattern, "")) / F.greatest(F.length("value"), F.lit(1))


def _changes(pattern: str) -> Column:
    return (F.length(F.regexp_replace("value", pattern, "|")) - F.length("value")) / F.greatest(F.length("value"), F.lit(1))


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with their features and, where a rule is sure, ``y`` (1 secret, 0 harmless)."""
    flag = lambda c: c.cast("double")
    rows = found.withColumn("_row", F.monotonically_increasing_id())
    rows = checkpointed(rows)
    runs = rows.select("_row", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{4,12}"), 0)).alias("piece"))
    covered = runs.join(F.broadcast(words), "piece").groupBy("_row").agg(F.sum(F.length("piece")).alias("covered"))
    rows = rows.join(covered, "_row", "left")
    size = F.greatest(F.length("value"), F.lit(1))
    named = F.col("lead").rlike(rf"(?i)(?:{NAMES})")
    assigned = F.col("lead").rlike(_ASSIGNED)
    dummy = F.lower("value").rlike(DUMMY) | F.lower("lead").rlike("example|sample|dummy")
    address, number, place = F.col("value").rlike(ADDRESS), F.col("value").rlike(NUMBER), F.col("value").rlike(PLACE)
    rows = rows.withColumns({
        "f_length": F.log1p(F.length("value").cast("double")), "f_digit": _share("[^0-9]"), "f_upper": _share("[^A-Z]"), "f_lower": _share("[^a-z]"), "f_other": _share("[A-Za-z0-9]"),
        "f_hex": flag(F.col("value").rlike("^[0-9a-fA-F]+$")), "f_class": _changes(_CLASS_CHANGE), "f_vowel": _changes(_VOWEL_CHANGE),
        "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / size, "f_covered": F.coalesce("covered", F.lit(0)) / size,
        "f_place": flag(place), "f_address": flag(address), "f_number": flag(number), "f_dummy": flag(dummy), "f_assigned": flag(assigned), "f_named": flag(named),
        "f_quoted": flag(F.col("quoted")), "f_before": flag(F.col("before").rlike("^[A-Za-z,.]{2,}$")), "f_after": flag(F.col("after").rlike("^[A-Za-z,.]{2,}$")),
    })
    random = (F.col("f_digit") >= 0.1) & (F.length("value") >= 16) & F.col("value").rlike("[A-Za-z]")
    # A short value behind a name is a secret for sure only with letters and digits, and no word of the corpus.
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]") & (F.col("f_covered") < 0.5)
    secret = ~dummy & (F.col("value").rlike(KEYS) | (assigned & (random | mixed) & ~address & ~place))
    letters = F.col("value").rlike(r"^[\p{L}.,;:!?'’-]+$")
    # Words of many documents are prose even behind a name ("the secret: nothing").
    harmless = dummy | address | number | place | (letters & (~named | (F.col("f_covered") >= 1)))
    return rows.withColumn("y", F.when(secret, 1.0).when(harmless, 0.0))


def findings(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Candidates that the forest takes for secrets.

    Columns ``doc_id, word_at, piece_at, n_chars, masked, value_sha256, score``. Without labelled
    candidates of both kinds there is no forest, and the rules alone decide (score 1).
    Null and empty texts and empty tables give no rows; repeated rows repeat; null doc_ids
    are kept; columns besides doc_id and text are ignored; a text without blanks is one word of
    many pieces. The value itself is not returned.
    """
    rows = checkpointed(described(candidates(docs), common_words(docs)))
    halves = [rows.filter(F.col("y") == y).orderBy(F.xxhash64("value", "doc_id", "word_at", "piece_at"), "_row").limit(train_rows) for y in (0.0, 1.0)]
    train = checkpointed(halves[0].unionByName(halves[1]))
    if train.select("y").distinct().count() < 2:
        scored = rows.filter("y = 1").withColumn("score", F.lit(1.0))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(labelCol="y", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=5, cacheNodeIds=False).fit(vectors.transform(train))
        scored = forest.transform(vectors.transform(rows)).withColumn("score", vector_to_array("probability")[1]).filter(F.col("score") >= THRESHOLD)
    return scored.select("doc_id", "word_at", "piece_at", F.length("value").alias("n_chars"), F.concat(F.substring("value", 1, 4), F.lit("...")).alias("masked"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), F.round("score", 6).alias("score"))


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    return findings(table(spark, sf_dir, "documents"))
