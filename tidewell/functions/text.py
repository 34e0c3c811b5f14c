"""Tokens, n-grams and text drawn from nested cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewell import schemas

# The character classes that decide what one product token is.
# SYMBOL is every character that is neither a Unicode space, a-z, 0-9, a Hangul
# syllable nor "+"; it is spelled as ranges, which the regex engine tests several
# times faster than the negated class.
HANGUL = "[가-힣]+"
JAMO = "[ㄱ-ㅎ|ㅏ-ㅣ]+"
LATIN = "[a-z0-9-]+"
SYMBOL = (
    r"[\x00-\x08\x0e-\x1b!-*,-/:-`{-\x84\x86-\x9f\xa1-\u167f\u1681-\u1fff\u200b-\u2027"
    r"\u202a-\u202e\u2030-\u205e\u2060-\u2fff\u3001-\uabff\ud7a4-\x{10ffff}]"
)
WORD = r"(?U)\b\w\w+\b"


def tokenize(text: Column, group_symbols: bool = False) -> Column:
    """Lower-cased tokens of ``text`` in order of appearance.

    ``group_symbols`` keeps a run of other characters as one token instead of
    one token per character.
    """
    symbol = SYMBOL + "+" if group_symbols else SYMBOL
    pattern = "|".join([HANGUL, JAMO, LATIN, symbol])
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def words(text: Column) -> Column:
    """Lower-cased words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_ngrams(text: Column, shortest: int = 1, longest: int = 3) -> Column:
    """All word n-grams of ``shortest`` to ``longest`` words."""

    def of_length(w: Column, n: int) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1)))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.coalesce(grams, F.array().cast("array<string>"))

    # the one-element array binds the word list, so the pattern runs once per row
    bound = F.transform(
        F.array(words(text)),
        lambda w: F.concat(*[of_length(w, n) for n in range(shortest, longest + 1)]),
    )
    return bound[0]


# Escapes of a Python literal and what they are in JSON without a quotation mark.
ESCAPES = {
    "'": r"\u0027", '"': r"\u0022", "\\": r"\u005c", "a": r"\u0007", "v": r"\u000b", "n": r"\n", "r": r"\r", "t": r"\t", "b": r"\b",
    "f": r"\f", "\n": "",
}
_ATOM = r"\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|[\s\S])?|[^\\]++"
_PIECE = r"""'[^']*+'|"[^"]*+"|[^'"]++|['"]"""
_BAD = "!"


def _unit(code: Column) -> Column:
    """A code unit as JSON spells it."""
    return F.concat(F.lit(r"\u"), F.lpad(F.hex(code), 4, "0"))


def _escape(atom: Column) -> Column:
    """One escape of a Python literal as an escape of JSON; a backslash alone where Python refuses it."""
    letter, rest = F.substring(atom, 2, 1), F.substr(atom, F.lit(3))
    wide = F.conv(rest, 16, 10).cast("long")
    over = wide - 0x10000
    pair = F.concat(_unit(over.bitwiseAND(0xFFC00) / 1024 + 0xD800), _unit(over.bitwiseAND(0x3FF) + 0xDC00))
    known = F.create_map(*[F.lit(x) for item in ESCAPES.items() for x in item])
    return (
        F.when(known[letter].isNotNull(), known[letter])
        .when(letter.isin("x", "u", "U", "N", "") & (F.length(atom) <= 2), F.lit("\\"))
        .when(letter == "x", F.concat(F.lit(r"\u00"), rest))
        .when(letter == "u", atom)
        .when(letter == "U", F.when(wide < 0x10000, _unit(wide)).when(wide <= 0x10FFFF, pair).otherwise("\\"))
        .when(letter.between("0", "7"), _unit(F.conv(F.substr(atom, F.lit(2)), 8, 10).cast("long")))
        .otherwise(F.concat(F.lit(r"\u005c"), letter))
    )


def literal_json(cell: Column) -> Column:
    """A Python (or JSON) literal of lists, dicts, strings, numbers, None and truth values as JSON; null if it is none.

    Escapes are rewritten first, so that no quotation mark is left inside a string; then the strings are told
    from what stands between them. Both are one pass over the text. Tuples, sets, named characters, numbers that JSON can't
    spell, strings side by side and repeated keys are refused.
    """
    atoms = F.transform(
        F.regexp_extract_all(cell, F.lit(_ATOM), F.lit(0)), lambda x: F.when(x.startswith("\\"), _escape(x)).otherwise(x)
    )

    def string(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(2), F.length(piece) - 2)
        text = F.replace(F.replace(inner, F.lit('"'), F.lit(r"\u0022")), F.lit("\t"), F.lit(r"\t"))
        return F.when(inner.rlike(r"[\n\r]"), F.lit(_BAD)).otherwise(F.concat(F.lit('"'), text, F.lit('"')))

    def between(piece: Column) -> Column:
        out = piece
        for name, value in (("None", "null"), ("True", "true"), ("False", "false")):
            out = F.regexp_replace(out, rf"\b{name}\b", value)
        out = F.regexp_replace(out, r",(\s*[\]}])", "$1")
        return F.when(piece.rlike(r"\\|[\[{:,]\s*,|['\"]"), F.lit(_BAD)).otherwise(out)

    pieces = F.transform(
        F.regexp_extract_all(F.array_join(atoms, ""), F.lit(_PIECE), F.lit(0)),
        lambda x: F.when((F.length(x) > 1) & x.rlike("^['\"]"), string(x)).otherwise(between(x)),
    )
    json = F.array_join(pieces, "")
    plain = F.regexp_replace(json, r"[\x00-\x1f]", " ")
    # the parser stops after one value; no text can end both frames early
    frames = [F.try_parse_json(F.concat(F.lit(a), plain, F.lit(b))).isNotNull() for a, b in (("[", "]"), ('{"":', "}"))]
    return F.when(frames[0] & frames[1], json)


def nested_names(cell: Column, bad: str = "fail") -> Column:
    """``[{"name": "A", ...}, ...]``, in Python's or JSON's notation, in a text cell -> ``"A ..."``.

    A null cell gives null. A cell that is no list of dicts fails, or gives null with ``bad="null"``.
    """
    json = literal_json(cell)
    listed = F.when(json.rlike(r"^\s*\[\s*(\]|\{)"), F.from_json(json, schemas.NAMED, {"allowUnquotedControlChars": "true"}))
    names = F.array_join(listed.getField("name"), " ")
    if bad == "null":
        return names
    return F.when(cell.isNull() | names.isNotNull(), names).otherwise(
        F.raise_error(F.concat(F.lit("Malformed nested cell: "), F.substring(cell, 1, 200))).cast("string")
    )
