"""Column expressions for review text.

Word characters and blanks are spelled out as Unicode classes, so a pattern
means the same on every JDK.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NOT_BLANK = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
#: Runs of anything but digits, Latin letters and what stands between them in Unicode; all blanks are among it.  What
#: has a code below 192 is listed one by one, which the JVM looks up in a table instead of trying range after range.
BETWEEN_WORDS = "[" + "".join(f"\\x{n:02x}" for n in range(0xC0) if not chr(n).isascii() or not chr(n).isalnum()) + r"\x{1680}\x{1efa}-\x{10ffff}]+"
TRIM_MARKS = r""".,!?"'()\[\]{}"""


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{BLANK}+|{BLANK}+$", "")


def squeeze(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, f"{BLANK}+", " "))


def is_blank(col: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(col, BLANK, "")), F.lit(0)) == 0


def tokens(col: Column) -> Column:
    """Words of a text; none for a blank one."""
    return F.array_remove(F.split(squeeze(col), " "), "")


def _quote(term: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", term)


def any_word(terms: Iterable[str]) -> str:
    """Pattern that finds one of the terms as whole words.

    The classes on both sides, not ``\\b``, so that accented letters count.
    """
    longest_first = sorted(terms, key=lambda term: (-len(term), term))
    return rf"(?<!{WORD})(?:{'|'.join(map(_quote, longest_first))})(?!{WORD})"


def _lookup(word: Column, dictionary: Mapping[str, str]) -> Column:
    """Dictionary value or NULL, for a dictionary of any size.

    The entries stand in an array of small maps, at the checksum of their key,
    so a word is compared with the few entries of one place.  The array is one
    constant, written as JSON.  Words too long for any key skip the search.
    """
    places: list[dict[str, str]] = [{} for _ in range(2 * len(dictionary))]
    for key, value in dictionary.items():
        places[zlib.crc32(key.encode()) % len(places)][key] = value
    table = F.from_json(F.lit(json.dumps(places)), "array<map<string,string>>")
    place = (F.crc32(word.cast("binary")) % len(places)).cast("int")
    longest = max(map(len, dictionary))
    return F.when(F.length(word) <= longest, F.try_element_at(F.get(table, place), word))


def translate(words: Column, dictionary: Mapping[str, str]) -> Column:
    if not dictionary:
        return words
    return F.transform(words, lambda w: F.coalesce(_lookup(w, dictionary), w))


def clean_text(col: Column, dictionary: Mapping[str, str]) -> Column:
    """Lower-case words only: no markup, links or signs; shorthand spelled out."""
    text = F.lower(F.coalesce(col, F.lit("")))
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    text = F.regexp_replace(text, rf"https?://{NOT_BLANK}+|www\.{NOT_BLANK}+", " ")
    words = F.split(F.trim(F.regexp_replace(text, BETWEEN_WORDS, " ")), " ")
    return F.array_join(translate(F.array_remove(words, ""), dictionary), " ")


def translate_shorthand(col: Column, dictionary: Mapping[str, str]) -> Column:
    """Spell out shorthand but keep the punctuation around each word."""

    def spelled(word: Column) -> Column:
        core = F.regexp_replace(word, f"^[{TRIM_MARKS}]+|[{TRIM_MARKS}]+$", "")
        found = _lookup(core, dictionary)
        before = F.regexp_extract(word, f"^[{TRIM_MARKS}]*", 0)
        after = F.regexp_extract(word, f"[{TRIM_MARKS}]*$", 0)
        return F.when(found.isNotNull(), F.concat(before, found, after)).otherwise(word)

    return F.array_join(
        F.transform(tokens(F.lower(F.coalesce(col, F.lit("")))), spelled), " "
    )


def strip_support_note(col: Column, mark: str = "||") -> Column:
    """The customer's own words: what stands before the support mark."""
    return strip(F.substring_index(F.coalesce(col, F.lit("")), mark, 1))


def clause_pattern(marks: str, words: Iterable[str]) -> str:
    ends = "".join("\\n" if m == "\n" else "\\" + m for m in marks)
    joined = "|".join(map(_quote, words))
    return rf"[{ends}]|(?<!{WORD})(?:{joined})(?!{WORD})"


def split_clauses(col: Column, marks: str, words: Iterable[str]) -> Column:
    """Clauses of at least three characters, in text order."""
    parts = F.split(F.lower(F.coalesce(col, F.lit(""))), clause_pattern(marks, words))
    return F.filter(F.transform(parts, strip), lambda clause: F.length(clause) >= 3)


def cue_sentiment(
    clause: Column, stars: Column, positive: Iterable[str], negative: Iterable[str]
) -> Column:
    """Cues decide when only one side occurs, else the stars do."""
    good, bad = clause.rlike(any_word(positive)), clause.rlike(any_word(negative))
    return (
        F.when(bad & ~good, 0.0)
        .when(good & ~bad, 1.0)
        .when(stars >= 4, 1.0)
        .when(stars <= 2, 0.0)
        .otherwise(0.5)
    )


def cue_polarity(
    col: Column, positive: Iterable[str], negative: Iterable[str]
) -> Column:
    """1, 0.5 or 0 by which side has more cue hits in the text."""
    text = F.lower(F.coalesce(col, F.lit("")))
    good = F.regexp_count(text, F.lit(any_word(positive)))
    bad = F.regexp_count(text, F.lit(any_word(negative)))
    return F.when(good > bad, 1.0).when(good < bad, 0.0).otherwise(0.5)


def first_date(col: Column) -> Column:
    """First ``d/m/yyyy`` in the text."""
    found = F.regexp_extract(col, r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "d/M/yyyy")


def helpful_id(link: Column, prefix: str) -> Column:
    number = F.nullif(F.regexp_extract(link, r"likeRating\(([0-9]+)\)", 1), F.lit(""))
    return F.concat(F.lit(prefix), number)


def helpful_count(label: Column) -> Column:
    """Number in parentheses, else the digits of the label, else ``0``."""
    inside = F.regexp_extract(label, r"\(([0-9]+)\)", 1)
    only_digits = F.regexp_replace(F.coalesce(label, F.lit("")), r"[^0-9]", "")
    return F.coalesce(
        F.nullif(inside, F.lit("")), F.nullif(only_digits, F.lit("")), F.lit("0")
    )


def with_name(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.get(F.transform(F.array(value), use), 0)


def runs(words: Column, size: int) -> Column:
    """Every ``size`` neighbouring words, joined by blanks, in text order."""
    found, count = words, F.size(words)
    for n in range(2, size + 1):
        places = F.greatest(count - (n - 1), F.lit(0))
        found = F.zip_with(F.slice(found, 1, places), F.slice(words, n, places), lambda a, b: F.concat(a, F.lit(" "), b))
    return found


def neighbours(words: Column) -> Column:
    """Each word but the last with its successor, as fields ``0`` and ``1``."""
    places = F.greatest(F.size(words) - 1, F.lit(0))
    return F.arrays_zip(F.slice(words, 1, places), F.slice(words, 2, places))


def segment(col: Column, phrases: Iterable[str]) -> Column:
    """Words with the listed phrases joined by ``_``: from the left, the longest one each time.

    Phrases are two to nine words joined by spaces, in any number.  Every place of a row looks up the longest
    phrase that begins there; its length is one digit of a string, which one pattern takes apart from the left.
    So the cost follows the length of the text, and nothing leaves the row.
    """
    sizes = {p: len(p.split(" ")) for p in phrases if 2 <= len(p.split(" ")) <= 9}
    if not sizes:
        return F.array_join(tokens(F.coalesce(col, F.lit(""))), " ")
    lengths = sorted(set(sizes.values()), reverse=True)
    listed = {p: str(n) for p, n in sizes.items()}

    def joined(words: Column) -> Column:
        longest = [F.transform(runs(words, n), lambda run: _lookup(run, listed)) for n in lengths]
        begins = longest[0]
        for shorter in longest[1:]:
            begins = F.zip_with(begins, shorter, lambda a, b: F.coalesce(a, b))
        digits = F.rpad(F.array_join(begins, "", "1"), F.size(words), "1")
        return glued(words, digits, lengths)

    return with_name(tokens(F.coalesce(col, F.lit(""))), joined)


def glued(words: Column, digits: Column, lengths: Sequence[int]) -> Column:
    """The words with runs joined by ``_``, from the left: a digit a word tells the length of the run that begins there."""
    if len(lengths) == 1:
        n = lengths[0]
        marks = F.translate(F.regexp_replace(digits, f"{n}.{{{n - 1}}}", "_" * (n - 1) + " "), "1", " ")
    else:
        taken = F.regexp_extract_all(digits, F.lit("|".join(f"{n}.{{{n - 1}}}" for n in lengths) + "|1"), F.lit(0))
        marks = F.array_join(F.transform(taken, lambda t: F.concat(F.repeat(F.lit("_"), F.length(t) - 1), F.lit(" "))), "")
    return F.rtrim(F.array_join(F.zip_with(words, F.split(marks, ""), lambda w, m: F.concat(w, m)), ""))


def word_ngrams(col: Column, sizes: Iterable[int] = (1, 2)) -> Column:
    """Space-joined runs of neighbouring words, for each size.

    Words of a single character are no terms and leave before runs are made.
    """
    words = F.filter(tokens(col), lambda word: F.length(word) > 1)
    return with_name(words, lambda w: F.flatten(F.array(*[runs(w, n) for n in sizes])))


def each_once(col: Column) -> Column:
    """The different words of a text."""
    return F.array_join(F.array_distinct(tokens(col)), " ")


def char_ngrams(col: Column, sizes: Iterable[int] = (3, 4, 5)) -> Column:
    """Character runs inside words, each word padded by a blank on both sides.

    Only the ends of a run may be blank, so none spans two words.  A padded
    word shorter than the smallest size counts once, whole.
    """
    patterns = [rf"(?=(.[^ ]{{{n - 2}}}.))" for n in sizes]
    if min(sizes) > 3:
        patterns.append(rf"(?=( [^ ]{{1,{min(sizes) - 3}}} ))")
    body = F.concat(F.lit(" "), squeeze(col), F.lit(" "))
    return with_name(body, lambda b: F.flatten(F.array(*[F.regexp_extract_all(b, F.lit(p), 1) for p in patterns])))
