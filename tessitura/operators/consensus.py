"""Pronunciation: layered dictionaries, fallback lookup, agreement, votes, locks, token mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import canonical_phones, literal_map, variant_hash
from .scans import find_hot_keys, last_seen, next_seen, running_sum, scan


def layered(entries: DataFrame) -> DataFrame:
    """Entry of the first layer that knows the key; inside a layer the last entry counts."""
    rank = F.struct(F.col("layer"), -F.col("position"))
    return entries.groupBy("key").agg(F.min_by(F.struct("value", "layer"), rank).alias("e")).select("key", "e.value", "e.layer")


def unique_variants(entries: DataFrame) -> DataFrame:
    """Keys with exactly one distinct value."""
    return entries.groupBy("key").agg(F.min("value").alias("value"), F.max("value").alias("__top")).where(
        "value = __top"
    ).drop("__top")


def key_conflicts(entries: DataFrame) -> DataFrame:
    """Entries that differ from the first entry of their key."""
    first = entries.groupBy("key").agg(F.min_by("value", "position").alias("kept"), F.min("position").alias("__first"))
    both = entries.join(first, "key")
    return both.where((F.col("value") != F.col("kept")) & (F.col("position") != F.col("__first"))).select("key", "position", "value", "kept")


def resolve(phrases: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Look phrases up by surface, then by reading, then by single characters, all or nothing.

    Only distinct (surface, reading) pairs are looked up; a phrase that fills a third of
    the corpus costs one lookup. ``dictionary`` has ``key, value, layer`` (value: phones
    joined by blanks). Adds ``phones``, ``found_by`` and ``source``.
    """
    words = phrases.select("surface", "reading").distinct()
    one = dictionary.select("key", "value", F.col("layer").cast("string").alias("source"))
    by = lambda c, p: one.select(F.col("key").alias(c), F.col("value").alias(f"{p}_value"), F.col("source").alias(f"{p}_source"))
    hit = words.join(by("surface", "s"), "surface", "left").join(by("reading", "r"), "reading", "left")
    open_ = hit.where("s_value is null and r_value is null and length(reading) > 1")
    chars = open_.select("surface", "reading", F.posexplode(F.split("reading", "")).alias("at", "ch"))
    spelled = chars.join(by("ch", "c"), "ch", "left").groupBy("surface", "reading").agg(
        F.count(F.lit(1)).alias("n"), F.count("c_value").alias("m"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "c_value"))), lambda x: x["c_value"]), " ").alias("c_value"),
        F.array_join(F.array_sort(F.collect_set("c_source")), "+").alias("c_source"),
    ).where("n = m").drop("n", "m")
    both = hit.join(spelled, ["surface", "reading"], "left")
    found = F.when(F.col("s_value").isNotNull(), "surface").when(F.col("r_value").isNotNull(), "reading").when(F.col("c_value").isNotNull(), "characters")
    answers = both.select(
        "surface", "reading",
        F.coalesce("s_value", "r_value", "c_value").alias("phones"),
        F.when(F.col("s_value").isNotNull(), F.col("s_source")).when(F.col("r_value").isNotNull(), F.col("r_source")).otherwise(F.col("c_source")).alias("source"),
        found.alias("found_by"),
    )
    return phrases.join(answers, ["surface", "reading"], "left")


def lyric_status(resolved: DataFrame, candidate_layers: Sequence[str] = (), allowed: Sequence[str] | None = None) -> DataFrame:
    """Variant hash, lock status and the first issue of each resolved phrase."""
    phones = F.split("phones", " ")
    key = F.coalesce(F.nullif("surface", F.lit("")), F.col("reading"))
    pending = F.col("source").isin(*candidate_layers) | (F.coalesce("source", F.lit("")) == "")
    bad = F.exists(phones, lambda p: ~p.isin(*allowed)) if allowed else F.lit(False)
    issue = F.when(F.coalesce("reading", F.lit("")) == "", "PRONUNCIATION_UNLOCKED").when(F.col("phones").isNull(), "UNKNOWN_DICTIONARY_ENTRY")
    issue = issue.when(bad, "UNKNOWN_PHONEME").when(pending, "PRONUNCIATION_CANDIDATE_REVIEW_REQUIRED")
    usable = F.col("phones").isNotNull() & (F.coalesce("reading", F.lit("")) != "")
    return resolved.withColumns(
        {
            "dictionary_variant": F.when(usable, variant_hash(key, phones)),
            "lock_status": F.when(usable, F.when(pending, "pending").otherwise("locked")),
            "issue": issue,
        }
    )


def assemble_lines(lines: DataFrame, words: DataFrame, keys: Sequence[str], text: Column) -> DataFrame:
    """Replace every word of a line by its pronunciation; one unknown word voids the line."""
    parts = lines.select(*keys, F.posexplode(text).alias("at", "key"))
    found = parts.join(words.select("key", "value"), "key", "left")
    return found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("words"), F.count("value").alias("known"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), " ").alias("joined"),
    ).select(*keys, "words", "known", F.when(F.col("words") == F.col("known"), F.col("joined")).otherwise("").alias("phones"))


def two_way(rows: DataFrame, key: Column, primary: Column, secondary: Column, unknown: Column, override: Column) -> DataFrame:
    """Two pronunciations agree when equal without pauses and free of unknown phones."""
    status = F.when(override, "auto_locked_override").when((primary == secondary) & ~unknown, "auto_locked").otherwise("pending")
    return rows.withColumns(
        {"primary_variant": variant_hash(key, primary), "secondary_variant": variant_hash(key, secondary), "crosscheck": status}
    )


def vote(variants: DataFrame, keys: Sequence[str], value: str, voter: str, quorum: int = 2) -> DataFrame:
    """Most frequent value per key (earliest voter on ties); locked from ``quorum`` votes on."""
    counted = variants.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("votes"), F.min(voter).alias("first"))
    # max_by needs the earliest voter last, so rank by votes and take the minimum of the pair.
    best = counted.groupBy(*keys).agg(
        F.min(F.struct((-F.col("votes")).alias("minus"), "first", F.col(value).alias("value"))).alias("b")
    )
    locked = -F.col("b.minus") >= quorum
    return best.select(
        *keys,
        (-F.col("b.minus")).cast("bigint").alias("quorum"),
        F.when(locked, "LOCKED").otherwise("UNRESOLVED").alias("status"),
        F.when(locked, F.col("b.value")).otherwise("").alias("phones"),
    )


def vote_phones(variants: DataFrame, keys: Sequence[str], phones: str, voter: str, quorum: int = 2) -> DataFrame:
    """Vote on canonical phones, so that spellings of one phone do not part the voters.

    A variant that is null or has no phone left casts no vote; a key without votes is
    UNRESOLVED with quorum 0. Phones of the result are joined by blanks.
    """
    said = variants.select(*keys, voter, F.array_join(canonical_phones(F.col(phones)), " ").alias("__said"))
    counted = vote(said.where(F.col("__said") != ""), keys, "__said", voter, quorum)
    # Null keys are keys too: every key gets a row, those with votes take theirs.
    silent = said.groupBy(*keys).agg(F.count_if(F.col("__said") != "").alias("__votes")).where("__votes = 0")
    return counted.unionByName(silent.select(*keys, F.lit(0).cast("bigint").alias("quorum"), F.lit("UNRESOLVED").alias("status"), F.lit("").alias("phones")))


def locks(occurrences: DataFrame, crosscheck: DataFrame, consensus: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lock or exclude every occurrence: consensus first, then the two-way result.

    ``crosscheck``: keys, primary_variant, secondary_variant, crosscheck. ``consensus``:
    keys, quorum, phones, only for locked phrases.
    """
    c = consensus.select(*keys, F.col("quorum").alias("c_quorum"), F.col("phones").alias("c_phones"))
    rows = occurrences.join(crosscheck, list(keys), "left").join(c, list(keys), "left")
    same = (F.coalesce("primary_variant", F.lit("")) != "") & (F.col("primary_variant") == F.col("secondary_variant"))
    action = F.when(F.col("c_quorum").isNotNull(), "THREE_WAY_G2P_CONSENSUS").when(F.col("crosscheck") == "pending", "PRUNE_LYRIC_UNIT")
    action = action.when(same, "EXISTING_TWO_WAY_LOCKED").otherwise("PRUNE_LYRIC_UNIT_NO_UNIQUE_LOCK")
    held = action.isin("THREE_WAY_G2P_CONSENSUS", "EXISTING_TWO_WAY_LOCKED")
    return rows.select(
        *keys,
        action.alias("resolution_action"),
        F.when(held, "LOCKED").otherwise("EXCLUDED").alias("status"),
        F.when(F.col("c_quorum").isNotNull(), F.col("c_quorum")).when(held, 2).otherwise(0).cast("bigint").alias("quorum"),
        F.when(F.col("c_quorum").isNotNull(), F.col("c_phones")).when(held, F.col("phones")).otherwise("").alias("phones"),
    )


# -- token mapping ----------------------------------------------------------------

# Tokens with one target phone wherever they stand.
PLAIN_TOKENS = {
    "sh": "ɕ", "ch": "tɕ", "ky": "c", "my": "mʲ", "ny": "ɲ", "ry": "ɾʲ", "by": "bʲ", "py": "p", "gy": "ɡ",
    "j": "dʑ", "y": "j", "cl": "ʔ", "a": "a", "e": "e", "i": "i", "o": "o", "u": "ɨ", "A": "a", "E": "e", "O": "o",
    "g": "ɡ", "r": "ɾ", "w": "w", "f": "ɸ",
}
# Consonants that change before i.
BEFORE_I = {"k": "c", "s": "ɕ", "z": "ʑ", "n": "ɲ", "r": "ɾʲ"}
# The moraic nasal by the token after it.
NASAL_NEXT = {
    "p": "m", "b": "m", "m": "m", "py": "m", "by": "m", "my": "m",
    "j": "ɲ", "ch": "ɲ", "sh": "ɲ", "ky": "ɲ", "gy": "ɲ", "ny": "ɲ",
    "t": "n", "d": "n", "n": "n", "ts": "n", "k": "ŋ", "g": "ŋ",
}
# Pauses, accent marks and lyric punctuation.
PAUSE_TOKENS = ("pau", "sil", ",", ".", "!", "?")
MARK_TOKENS = ("[", "]", "#")
PUNCTUATION = ("「", "」", "（", "）", "(", ")", "…", "♪", "☆", "―", "．", "＆", "&", "'", '"')
# Palatal onsets and long vowels.
PALATAL = ("ky", "my", "ny", "ry", "by", "py", "gy")
LONG_VOWELS = {"a": "aː", "e": "eː", "i": "iː", "o": "oː", "ɨ": "ɨː"}


def map_tokens(rows: DataFrame, tokens: str, allowed: Sequence[str], merge_long: bool = False, out: str = "m") -> DataFrame:
    """Add ``out``: struct(phones, review_flags, unknown) of a column of token arrays.

    Every distinct array is mapped once. What follows a token is a scan from its right end
    and the place in a run of equal vowels a scan from its left end, so the work is linear in
    the tokens and a long text is no burden. Null arrays give null, empty ones empty fields,
    null tokens are passed over.
    """
    none = F.array().cast("array<string>")
    keyed = rows.withColumn("__text", F.sha2(F.to_json(F.col(tokens)), 256))
    once = keyed.where(F.size(tokens) > 0).select("__text", F.col(tokens).alias("__tokens")).dropDuplicates(["__text"])
    parts = once.select("__text", F.posexplode("__tokens").alias("at", "t"))
    key, order, t = ["__text"], ["at"], F.col("t")
    hot = find_hot_keys(parts, key)
    spoken = F.when(~t.isin(*MARK_TOKENS, *PAUSE_TOKENS), t)
    seen = scan(parts, key, order, [next_seen("__next", spoken, inclusive=False)], hot)

    nxt = F.coalesce("__next", F.lit(""))
    blank = t.rlike(r"^\s+$") | t.isin(*PUNCTUATION)
    soft = (nxt == "i") & t.isin(*BEFORE_I)
    voiceless = F.when(t == "I", F.lit("i̥" if "i̥" in allowed else "i")).when(t == "U", F.lit("ɨ̥" if "ɨ̥" in allowed else "ɨ"))
    phone = F.when(blank | t.isin(*MARK_TOKENS), F.lit(None)).when(t.isin(*PAUSE_TOKENS), "SP")
    phone = phone.when(t == "N", F.coalesce(F.try_element_at(literal_map(NASAL_NEXT), nxt), F.lit("ɴ")))
    phone = phone.when(soft, F.try_element_at(literal_map(BEFORE_I), t))
    phone = phone.otherwise(F.coalesce(voiceless, F.try_element_at(literal_map(PLAIN_TOKENS), t), t))
    flag = F.when(blank, "punctuation").when(t.isin(*PALATAL), "contextual_palatalization").when(t.isin(*PAUSE_TOKENS), "pause")
    flag = flag.when(t == "cl", "sokuon").when(t == "N", "nasal_context").when(soft, "contextual_mapping")
    mapped = seen.select("__text", "at", phone.alias("phone"), flag.alias("flag")).withColumn("joined", F.lit(False))
    if merge_long:
        mapped = merge_long_vowels(mapped, key, "at", "phone", [v for v in LONG_VOWELS.values() if v in allowed], hot)

    found = mapped.groupBy("__text").agg(F.array_sort(F.collect_list(F.struct("at", "phone", "flag"))).alias("l"), F.bool_or("joined").alias("joined"))
    phones = F.filter(F.transform("l", lambda x: x["phone"]), lambda p: p.isNotNull())
    flags = F.array_distinct(F.filter(F.transform("l", lambda x: x["flag"]), lambda f: f.isNotNull()))
    flags = F.when(F.col("joined"), F.array_union(flags, F.array(F.lit("long_vowel")))).otherwise(flags)
    unknown = F.array_distinct(F.filter(phones, lambda p: ~p.isin(*allowed))) if allowed else none
    answers = found.select(F.col("__text").alias("__key"), F.struct(phones.alias("phones"), flags.alias("review_flags"), unknown.alias("unknown")).alias("__mapped"))
    empty = F.when(F.size(tokens) == 0, F.struct(none.alias("phones"), none.alias("review_flags"), none.alias("unknown")))
    joined = keyed.join(answers, F.col("__text") == F.col("__key"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce("__mapped", empty).alias(out))


def merge_long_vowels(rows: DataFrame, keys: Sequence[str], at: str, phone: str, long_forms: Sequence[str], hot=None) -> DataFrame:
    """Two equal vowels in a row become the long form, pairs taken from the left.

    ``phone`` holds the long form at the first of a pair and null at the second, where
    ``joined`` is true. Rows without a phone do not part two equal ones.
    """
    long_of = {k: v for k, v in LONG_VOWELS.items() if v in long_forms}
    if not long_of:
        return rows
    p = F.col(phone)
    begins = F.when(p.isNotNull() & ~p.eqNullSafe(F.col("__before")), F.col("__n"))
    placed = scan(
        rows, keys, [at],
        [last_seen("__before", p, inclusive=False), next_seen("__after", p, inclusive=False), running_sum("__n", F.when(p.isNotNull(), 1).otherwise(0))],
        hot, [last_seen("__run", begins)],
    )
    vowel = F.coalesce(p.isin(*long_of), F.lit(False))
    second = vowel & ((F.col("__n") - F.col("__run")) % 2 == 1)
    first = vowel & ~second & p.eqNullSafe(F.col("__after"))
    merged = F.when(second, F.lit(None)).when(first, F.try_element_at(literal_map(long_of), p)).otherwise(p)
    return placed.select(*[c for c in rows.columns if c not in (phone, "joined")], merged.alias(phone), second.alias("joined"))
