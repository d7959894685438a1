"""Scalar column functions: time, pitch, level, identifiers, sequences, text classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_RATE = 44_100

# Review states that count as settled.
ACCEPTED_STATUSES = ("accepted", "auto_locked", "resolved", "waived")
# Spellings of one phone that count as equal.
PHONE_ALIASES = {
    "i:": "i", "iː": "i", "ɨ:": "ɨ", "ɨː": "ɨ", "u:": "u", "uː": "u", "e:": "e", "eː": "e",
    "o:": "o", "oː": "o", "sil": "SP", "sp": "SP", "spn": "spn",
}
# Semitone of each note letter above C.
NOTE_LETTERS = {"C": 0, "D": 2, "E": 4, "F": 5, "G": 7, "A": 9, "B": 11}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


# -- time -------------------------------------------------------------------------


def to_sample(seconds: Column, rate: int = SAMPLE_RATE) -> Column:
    """Nearest sample index, halves to even."""
    return F.rint(seconds * rate).cast("bigint")


def clock_seconds(text: Column) -> Column:
    """``h:mm:ss,mmm`` (comma or point) to seconds."""
    parts = F.split(F.translate(text, ",", "."), ":")
    return parts[0].cast("int") * 3600 + parts[1].cast("int") * 60 + parts[2].cast("double")


# -- pitch and level --------------------------------------------------------------


def note_to_midi(note: Column) -> Column:
    """Note name with optional accidental and cents suffix to a MIDI number; rest gives null."""
    name = F.trim(note)
    form = r"^([A-Ga-g])([#b]?)(-?\d+)([+-]\d+(\.\d+)?)?$"
    letter = F.upper(F.regexp_extract(name, form, 1))
    step = F.when(F.regexp_extract(name, form, 2) == "#", 1).when(F.regexp_extract(name, form, 2) == "b", -1).otherwise(0)
    octave = F.try_to_number(F.regexp_extract(name, form, 3), F.lit("S99")).cast("bigint")
    tone = F.try_element_at(literal_map(NOTE_LETTERS), letter)
    return F.when(name.rlike(form), ((octave + 1) * 12 + tone + step).cast("bigint"))


def midi_to_hz(midi: Column) -> Column:
    return 440.0 * F.pow(F.lit(2.0), (midi - 69) / 12)


def hz_to_midi(hz: Column) -> Column:
    """Fractional MIDI number; null for silence and non-finite values."""
    good = (hz > 0) & ~F.isnan(hz) & (hz < float("inf"))
    return F.when(good, 69.0 + 12.0 * F.log2(hz / 440.0))


def octave_distance(semitones: Column) -> Column:
    """Distance to the nearest octave from -2 to +2."""
    return F.least(*[F.abs(semitones - 12.0 * o) for o in range(-2, 3)])


def dbfs(rms: Column, floor: float = 1e-9) -> Column:
    return 20.0 * F.log10(F.greatest(rms, F.lit(floor)))


def db_gain(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20.0)


# -- numbers ----------------------------------------------------------------------


def safe_double(value: Column, default: float | None = None) -> Column:
    """Number or default; text that is no number, NaN and infinities give the default."""
    number = value.try_cast("double")
    good = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    return F.when(good, number).otherwise(F.lit(default).cast("double"))


def clip_round(value: Column, low: float, high: float, digits: int = 3) -> Column:
    return F.bround(F.least(F.greatest(value, F.lit(low)), F.lit(high)), digits)


def short_number(value: Column, digits: int = 10) -> Column:
    """Text of a number with so many digits and no idle zeros; an exponent below 1e-4 and from 10^digits on."""
    long = F.format_string(f"%.{digits - 1}e", value)
    rounded = long.cast("double")
    plain = F.regexp_replace(rounded.cast(f"decimal(38,{digits + 4})").cast("string"), r"\.?0+$", "")
    fits = (rounded == 0) | F.abs(rounded).between(1e-4, 10.0**digits) & (F.abs(rounded) < 10.0**digits)
    return F.when(fits, F.when(rounded == 0, "0").otherwise(plain)).otherwise(F.regexp_replace(long, r"\.?0+(?=e)", ""))


def truthy(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("1", "true", "yes", "y"), F.lit(False))


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


# -- identifiers ------------------------------------------------------------------


def short_sha1(prefix: str, *parts: Column) -> Column:
    """Prefix plus 12 hex digits of sha1 over the parts joined by bars; null counts as empty."""
    raw = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(raw), 1, 12))


def variant_hash(key: Column, phones: Column) -> Column:
    """16 hex digits over the key, a tab and the phones joined by blanks."""
    return F.substring(F.sha2(F.concat(key, F.lit("\t"), F.array_join(phones, " ")), 256), 1, 16)


def canonical_json(*columns: str) -> Column:
    """JSON text with keys in name order and no blanks."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))


# -- sequences --------------------------------------------------------------------


def tokens(text: Column) -> Column:
    """Split on any blank run; empty text and null give an empty array."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), " ")
    return F.filter(words, lambda w: w != "")


def numbers(text: Column) -> Column:
    return F.transform(tokens(text), lambda w: w.cast("double"))


def integers(text: Column) -> Column:
    return F.transform(tokens(text), lambda w: w.cast("double").cast("bigint"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def canonical_phones(phones: Column) -> Column:
    """Trim, drop empty ones, and map alternative spellings."""
    aliases = literal_map(PHONE_ALIASES)
    kept = F.filter(F.transform(phones, lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(kept, lambda p: F.coalesce(F.try_element_at(aliases, p), p))


def without_pauses(phones: Column) -> Column:
    return F.filter(phones, lambda p: ~p.isin("SP", "AP"))


# -- text and names ---------------------------------------------------------------


def clean_caption(line: Column) -> Column:
    """Remove tags, squeeze blanks and tabs, trim."""
    return F.trim(F.regexp_replace(F.regexp_replace(line, r"<[^>]+>", ""), r"[ \t]+", " "))


# The kana range, and the marker that recorders put into file names.
KANA = "[぀-ヿ]"
RECORDING_MARKER = "_32k_mono.wav_"


def has_kana(text: Column) -> Column:
    return text.rlike(KANA)


def has_latin(text: Column) -> Column:
    return text.rlike("[A-Za-z]")


def safe_path(path: Column) -> Column:
    """Relative, non-empty, without parent steps."""
    norm = F.translate(F.coalesce(path, F.lit("")), "\\", "/")
    bad = (norm == "") | norm.startswith("/") | norm.rlike(r"^[A-Za-z]:") | norm.rlike(r"(^|/)\.\.(/|$)")
    return ~bad


def recording_group(name: Column, marker: str = RECORDING_MARKER) -> Column:
    """Part before the marker, else the name without its last suffix."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.when(F.instr(name, marker) > 0, F.split_part(name, F.lit(marker), F.lit(1))).otherwise(stem)


def wav_stem(name: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"\.wav$", "")


def checkpoint_numbers(name: Column) -> Column:
    """Epoch and step from ``_e<epoch>_s<step>``; null when absent."""
    pick = lambda i: F.regexp_extract(name, r"_e(\d+)_s(\d+)", i).try_cast("bigint")
    return F.struct(pick(1).alias("epoch"), pick(2).alias("step"))
