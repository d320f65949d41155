"""Text analysis as plain column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word-break punctuation of Unicode Standard Annex 29, the
# longest token and the characters whose lower case is not one to one.
MID_NUM_LET = ".'\u2018\u2019\u2024\ufe52\uff07\uff0e"
MID_LETTER = ":\u00b7\u0387\u05f4\u2027\ufe13\ufe55\uff1a"
MID_NUM = ",;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b"
MAX_TOKEN_LENGTH = 255
SIMPLE_LOWER = {"İ": "i", "Σ": "σ"}
CONNECTORS = "_\u203f\u2040\u2054\ufe33\ufe34\ufe4d\ufe4e\ufe4f\uff3f\u202f"

LETTER = r"[\p{L}\p{M}\p{Nl}]"
# Format characters belong to the word before them; the zero-width space parts words.
FORMATS = "".join(
    chr(c) for c in range(0x110000) if c != 0x200B and unicodedata.category(chr(c)) == "Cf"
)
FORMAT = r"\p{Cf}&&[^\x{200B}]"
# The general categories of all of these come first: one test rules out a space.
JOINER = r"\p{Po}\p{Pi}\p{Pf}\p{Sm}"
JOINS_LETTERS = f"[{JOINER}&&[{MID_NUM_LET}{MID_LETTER}]]"
JOINS_DIGITS = f"[{JOINER}&&[{MID_NUM_LET}{MID_NUM}]]"

# Characters of words that most texts are made of.  Listed one by one they cost one look into
# a table, where every category or range is a test of its own.
COMMON = "abcdefghijklmnopqrstuvwxyz0123456789_ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"

# One separator character: neither part of a word, nor punctuation that joins
# two letters or two digits.  No quantified group without a small bound, so a
# hostile document cannot make the regex engine recurse.
PLAIN_SEPARATOR = (
    rf"[[^{COMMON}]&&[^\p{{L}}\p{{M}}\p{{Nl}}\p{{Nd}}_]]"
    rf"(?<!{LETTER}{JOINS_LETTERS}(?={LETTER}))"
    rf"(?<!\p{{Nd}}{JOINS_DIGITS}(?=\p{{Nd}}))"
)
IDEOGRAPH = r"([\x{2E80}-\x{3FFFF}&&[\p{IsHan}\p{IsHiragana}]]\p{M}*+)"
LINE_BREAK = r"\r\n|\r|\n"

# Characters of script Katakana and those that are treated as such, emoji that
# are shown as such by themselves, and symbols that are with a selector behind them.
KATAKANA = r"\p{IsKatakana}\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}\x{30FC}\x{FF70}"
SHOWN = (
    "231A-231B 23E9-23EC 23F0 23F3 25FD-25FE 2614-2615 2648-2653 267F 2693 26A1 26AA-26AB "
    "26BD-26BE 26C4-26C5 26CE 26D4 26EA 26F2-26F3 26F5 26FA 26FD 2705 270A-270B 2728 274C 274E "
    "2753-2755 2757 2795-2797 27B0 27BF 2B1B-2B1C 2B50 2B55 1F004 1F0CF 1F18E 1F191-1F19A 1F201 "
    "1F21A 1F22F 1F232-1F236 1F238-1F23A 1F250-1F251 1F300-1F320 1F32D-1F335 1F337-1F37C "
    "1F37E-1F393 1F3A0-1F3CA 1F3CF-1F3D3 1F3E0-1F3F0 1F3F4 1F3F8-1F3FA 1F400-1F43E 1F440 "
    "1F442-1F4FC 1F4FF-1F53D 1F54B-1F54E 1F550-1F567 1F57A 1F595-1F596 1F5A4 1F5FB-1F64F "
    "1F680-1F6C5 1F6CC 1F6D0-1F6D2 1F6D5-1F6D7 1F6DC-1F6DF 1F6EB-1F6EC 1F6F4-1F6FC 1F7E0-1F7EB "
    "1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FAFF"
)
SYMBOLS = (
    "A9 AE 203C 2049 2122 2190-21FF 2300-23FF 25A0-27BF 2900-297F 2B00-2BFF 3030 303D 3297 3299 "
    "1F000-1FAFF"
)
FLAG, SKIN, TAG = r"[\x{1F1E6}-\x{1F1FF}]", r"[\x{1F3FB}-\x{1F3FF}]", r"[\x{E0020}-\x{E007F}]"


def char_ranges(listed: str) -> str:
    """The inside of a character class from a list of code points and ranges of them."""
    return "".join(
        "-".join(rf"\x{{{end}}}" for end in part.split("-")) for part in listed.split()
    )


# At most nine joined emoji make one; a longer chain goes on as the next.
EMOJI = rf"(?:[{char_ranges(SHOWN)}]\x{{FE0F}}?|[{char_ranges(SYMBOLS)}]\x{{FE0F}}){SKIN}?"
EMOJI_TOKEN = (
    rf"({FLAG}{{2}}|[0-9]\x{{FE0F}}?\x{{20E3}}|{EMOJI}(?:\x{{200D}}{EMOJI}){{0,8}}+{TAG}{{0,32}}+)"
    rf"|[{char_ranges(SYMBOLS)}]"
)
# Between katakana and other letters or digits there is a break, whatever marks are between.
MARKS = rf"[\p{{M}}\x{{FF9E}}\x{{FF9F}}[{FORMAT}]]{{0,8}}"
NOT_KATAKANA = rf"[\p{{L}}\p{{Nl}}\p{{Nd}}&&[^{KATAKANA}\x{{FF9E}}\x{{FF9F}}]]"
KATAKANA_BREAK = (
    rf"(?<=[{KATAKANA}]{MARKS})(?={NOT_KATAKANA})|(?<={NOT_KATAKANA}{MARKS})(?=[{KATAKANA}])"
)
# Format characters beside a joining mark do not part what it joins, up to eight of them.
_LETTER = rf"[\p{{L}}\p{{M}}\p{{Nl}}&&[^{KATAKANA}]]"
_BETWEEN = rf"[{FORMAT}]{{0,8}}"
UNUSUAL_SEPARATOR = (
    rf"[^\p{{L}}\p{{M}}\p{{Nl}}\p{{Nd}}{CONNECTORS}{KATAKANA}{char_ranges(SYMBOLS)}[{FORMAT}]]"
    rf"(?<!{_LETTER}{_BETWEEN}{JOINS_LETTERS}(?={_BETWEEN}{_LETTER}))"
    rf"(?<!\p{{Nd}}{_BETWEEN}{JOINS_DIGITS}(?={_BETWEEN}\p{{Nd}}))"
)
UNUSUAL = rf"[{CONNECTORS[1:]}{KATAKANA}{char_ranges(SYMBOLS)}[{FORMAT}]]|\x{{20E3}}"
# A superset of them in few comparisons; the class above takes some two hundred a character.
MAYBE_UNUSUAL = r"[\x{A9}\x{AD}\x{AE}\x{0600}-\x{10FFFF}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_simple(text: Column) -> Column:
    """Lower-case character by character, without context rules."""
    for upper, lower in SIMPLE_LOWER.items():
        text = F.replace(text, F.lit(upper), F.lit(lower))
    return F.lower(text)


def is_word(piece: Column) -> Column:
    """What lies between separators is a word unless connectors and format characters are all."""
    return F.ltrim(piece, F.lit(CONNECTORS + FORMATS)) != ""


def is_plain_word(piece: Column) -> Column:
    """The same where the underscore is the only connector."""
    return F.when(piece.startswith("_"), F.ltrim(piece, F.lit("_")) != "").otherwise(piece != "")


def without_loose_format(pieces: Column) -> Column:
    """Format characters in front of a piece follow no word and belong to none."""
    front = rf"^[{FORMAT}]+"
    return F.when(
        F.exists(pieces, lambda p: p.rlike(front)),
        F.transform(pieces, lambda p: F.regexp_replace(p, front, "")),
    ).otherwise(pieces)


def tokenize(text: Column) -> Column:
    """Array of lower-cased word tokens in text order.

    Ideographs and emoji stand alone, katakana does not join other letters; tokens longer
    than the limit are cut into pieces.
    """
    lowered = lower_simple(text)
    spaced = F.regexp_replace(lowered, IDEOGRAPH, " $1 ")
    apart = F.regexp_replace(spaced, KATAKANA_BREAK, " ")
    apart = F.regexp_replace(apart, EMOJI_TOKEN, " $1 ")
    unusual = F.filter(let(F.split(apart, UNUSUAL_SEPARATOR), without_loose_format), is_word)

    def plain(spaced: Column) -> Column:
        pieces = F.split(spaced, PLAIN_SEPARATOR)
        return F.when(F.contains(text, F.lit("_")), F.filter(pieces, is_plain_word)).otherwise(
            F.array_remove(pieces, "")
        )

    # One look at the text tells whether every piece needs the longer tests.  All ideographs
    # are among the characters looked for first.
    words = (
        F.when(~text.rlike(MAYBE_UNUSUAL), plain(lowered))
        .when(text.rlike(UNUSUAL), unusual)
        .otherwise(plain(spaced))
    )

    def chop(word: Column) -> Column:
        pieces = F.regexp_extract_all(word, F.lit(rf"(?s).{{1,{MAX_TOKEN_LENGTH}}}"), F.lit(0))
        return F.when(F.length(word) <= MAX_TOKEN_LENGTH, F.array(word)).otherwise(
            F.filter(pieces, is_word)
        )

    return let(
        words,
        lambda ws: F.when(
            # Bytes are known without a count and are no fewer than the characters.
            F.exists(ws, lambda w: F.octet_length(w) > MAX_TOKEN_LENGTH),
            F.flatten(F.transform(ws, chop)),
        ).otherwise(ws),
    )


def count_tokens(tokens: Column) -> Column:
    """Token array -> struct(length, n_terms, terms, tfs).

    ``terms`` holds the distinct tokens in byte order and ``tfs`` their counts.
    A document is one row, so sorting its tokens and measuring the runs counts
    them without any shuffle.
    """

    def describe(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered,
                lambda t, i: F.when((i == 0) | (t != F.get(ordered, i - 1)), i).otherwise(-1),
            ),
            lambda i: i >= 0,
        )
        return let(starts, lambda at: runs(ordered, at))

    def runs(ordered: Column, at: Column) -> Column:
        def run_length(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(at, i + 1), F.size(ordered))
            return (end - start).cast("bigint")

        return F.struct(
            F.size(ordered).cast("bigint").alias("length"),
            F.size(at).cast("bigint").alias("n_terms"),
            F.transform(at, lambda i: F.get(ordered, i)).alias("terms"),
            F.transform(at, run_length).alias("tfs"),
        )

    return let(F.sort_array(tokens), describe)


def line_window(text: Column, top: int | None = None, bottom: int | None = None) -> Column:
    """Keep the first ``top`` and the last ``bottom`` lines, each line once.

    ``None`` leaves a side unset; with both unset the text stays whole.
    """
    if top is None and bottom is None:
        return text
    lines = F.split(F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK)

    def window(ls: Column) -> Column:
        def kept(_: Column, i: Column) -> Column:
            in_top = F.lit(False) if top is None else i < top
            in_bottom = F.lit(False) if bottom is None else i >= F.size(ls) - bottom
            return in_top | in_bottom

        ended = F.transform(F.filter(ls, kept), lambda line: F.concat(line, F.lit("\n")))
        return F.array_join(ended, "")

    return F.when(text == "", F.lit("")).otherwise(let(lines, window))


def decode_utf8(content: Column) -> Column:
    """Bytes to text; malformed sequences become the replacement character."""
    return F.make_valid_utf8(content.cast("string"))


def extension(path: Column) -> Column:
    """From the last dot of the whole path on; empty without a dot past the first place."""
    return F.regexp_extract(path, r"(?s)^.+(\.[^.]*)$", 1)


def format_term(term: Column, tf: Column, df: Column, tfidf: Column) -> Column:
    """One report line of a ranked term."""
    return F.format_string("term='%s', tf=%d, df=%d, tfxidf=%.2f", term, tf, df, tfidf)
