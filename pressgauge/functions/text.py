"""Text functions: escapes, delimiters, tokens, stop words, sentences."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BYTE_ESCAPE = "%[0-9a-fA-F]{2}"
UNIT_ESCAPE = "%u[0-9a-fA-F]{4}"
ONLY_UNITS = "^[^%]*+(?:%[^%]{5})*+\\z"
TERM_DELIMITERS = "[，。;；、]"
SENTENCE_DELIMITERS = ",|。|\t|\n|，|："
LATIN_WORD = "^[a-zA-Z.' ]+\\z"
CJK_TOKEN = "^[\\u4E00-\\u9FFF]+\\z"
SIX_DIGITS = "^\\d{6}\\z"
START_MARKER = "始##始"

Tokeniser = Callable[[Column], Column]


def words(text: Column) -> Column:
    """Default tokeniser: maximal runs of letters."""
    return F.filter(F.split(text, "[^\\p{L}]+"), lambda w: w != "")


def strip_bom(text: Column) -> Column:
    return F.regexp_replace(text, "^\\uFEFF", "")


def unit_escapes_to_bytes(text: Column) -> Column:
    """Rewrite ``%uABCD`` as ``%AB%CD``.

    Pieces between percent signs are judged by length: five characters become two byte escapes,
    two characters are decoded on their own as UTF-8, every other length vanishes. Text before
    the first percent sign stays. An undecodable two-character piece makes the result null.
    """
    pieces = F.split(text, "%")
    tail = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.when(
            F.length(p) == 5,
            F.concat(F.lit("%"), F.substring(p, 2, 2), F.lit("%"), F.substring(p, 4, 2)),
        )
        .when(F.length(p) == 2, F.try_url_decode(F.concat(F.lit("%"), p)))
        .otherwise(F.lit("")),
    )
    general = F.when(
        ~F.exists(tail, lambda p: p.isNull()), F.concat(pieces[0], F.array_join(tail, ""))
    )
    # Where all pieces have five characters, one pass over the text does, without a list of them.
    return F.when(text.rlike(ONLY_UNITS), F.regexp_replace(text, "%[^%]([^%]{2})([^%]{2})", "%$1%$2")).otherwise(general)


def _utf16_run(run: Column) -> Column:
    """Decode one run of byte escapes as UTF-16: byte-order mark honoured, lone surrogates replaced."""
    digits = F.replace(run, F.lit("%"), F.lit(""))
    # Without a unit that begins with a byte from D8 to DF there is no surrogate to look at; a mark may swap the bytes.
    surrogate = run.rlike("^(?:%(?![dD][89a-fA-F])..%..)*+%[dD][89a-fA-F]") | run.rlike("^%[fF][fF]%[fF][eE]")
    return F.when(surrogate, _utf16_surrogates(digits)).otherwise(
        F.decode(F.unhex(digits), "UTF-16")
    )


def _utf16_surrogates(digits: Column) -> Column:
    units = F.regexp_replace(F.upper(digits), "(.{4})", "$1,")
    swapped = F.regexp_replace(units, "(..)(..),", "$2$1,")
    big_endian = F.when(units.startswith("FFFE,"), swapped).otherwise(units)
    unmarked = F.regexp_replace(big_endian, "^FEFF,", "")
    low_fixed = F.regexp_replace(unmarked, "(?<!D[89AB]..,)D[C-F]..,", "FFFD,")
    paired = F.regexp_replace(low_fixed, "D[89AB]..,(?!D[C-F])", "FFFD,")
    return F.decode(F.unhex(F.regexp_replace(paired, ",", "")), "UTF-16BE")


def decode_utf16_escapes(text: Column) -> Column:
    """URL-decode with byte escapes read as UTF-16 and plus as space; null on a broken escape."""
    runs = F.regexp_extract_all(text, F.lit("((?:%[0-9a-fA-F]{2})+|[^%]+|%)"), F.lit(1))

    def joined(rs: Column) -> Column:
        decoded = F.transform(
            rs, lambda r: F.when(r.startswith("%"), _utf16_run(r)).otherwise(F.translate(r, "+", " ")),
        )
        return F.when(~F.exists(rs, lambda r: r == "%"), F.array_join(decoded, ""))

    # Unfolded from a list, so that the runs are found once.
    return F.transform(F.array(runs), joined)[0]


def _decode_once(text: Column) -> Column:
    return (
        F.when(text.rlike(UNIT_ESCAPE), decode_utf16_escapes(unit_escapes_to_bytes(text)))
        .when(text.rlike(BYTE_ESCAPE), F.try_url_decode(text))
        .otherwise(text)
    )


def decode_escapes(text: Column, usual_depth: int = 3) -> Column:
    """Decode url escapes until none is left; null when an escape is broken.

    Nearly every string is stable after ``usual_depth`` passes. Each pass that changes a string
    shortens it by two for every escape, so the rare deeper ones are finished by a second fold bounded by the
    length, which does nothing more once the string is stable.
    """
    def unstable(s: Column) -> Column:
        return s.rlike(BYTE_ESCAPE) | s.rlike(UNIT_ESCAPE)

    def shallow(s: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(usual_depth)), s, lambda acc, _: _decode_once(acc))

    def finish(s: Column) -> Column:
        def state(t: Column) -> Column:
            return F.struct(t.alias("text"), F.coalesce(unstable(t), F.lit(False)).alias("open"))

        # A level of encoding holds at least two characters more for each escape.
        rounds = F.sequence(F.lit(1), F.floor(F.length(s) / 2).cast("int") + 1)
        folded = F.aggregate(
            rounds, state(s),
            lambda acc, _: F.when(acc["open"], F.transform(F.array(_decode_once(acc["text"])), state)[0]).otherwise(acc),
        )
        return F.when(unstable(s), folded["text"]).otherwise(s)

    return F.transform(F.array(F.when(text.contains("%"), shallow(text)).otherwise(text)), finish)[0]


def normalise_delimiters(text: Column) -> Column:
    """Space and the wide or ideographic separators become commas."""
    return F.regexp_replace(F.translate(text, " ", ","), TERM_DELIMITERS, ",")


def segment_gate(word: Column, tokeniser: Tokeniser = words, min_length: int = 6) -> Column:
    """Tokens of a long word that is not purely Latin; any other word stays whole."""
    return F.when(
        (F.length(word) >= min_length) & ~word.rlike(LATIN_WORD), tokeniser(word)
    ).otherwise(F.array(word))


def remove_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words, keep order and repeats."""
    stop = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens


def whitelist_tokens(tokens: Column, patterns: Sequence[str] = (CJK_TOKEN, SIX_DIGITS)) -> Column:
    """Keep tokens that match one of the patterns; blanks and the start marker go first."""
    def keep(t: Column) -> Column:
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | t.rlike(pattern)
        return hit & (t != " ") & (t != START_MARKER)

    return F.filter(tokens, keep)


def clean_document(
    text: Column,
    stop_words: Sequence[str],
    tokeniser: Tokeniser = words,
    patterns: Sequence[str] = (CJK_TOKEN, SIX_DIGITS),
) -> Column:
    """Tokens of the trimmed text, whitelisted, without stop words, joined by a slash."""
    tokens = whitelist_tokens(tokeniser(F.trim(text)), patterns)
    return F.array_join(remove_stop_words(tokens, stop_words), "/")


def sentences(text: Column) -> Column:
    """Split on commas, full stops, tabs, line breaks and wide colons; ASCII stops do not split."""
    return F.split(text, SENTENCE_DELIMITERS)
