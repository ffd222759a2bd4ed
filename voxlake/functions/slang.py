"""Escapes, stretched words and slang, as built-in expressions.

A word character is a letter, a number or '_' in any script, so words end where a Python regex
would end them; Java's own \\w and \\b only know ASCII.
"""

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlake.fixed_values import ESCAPE, SLANG, STRETCH, STRETCHED_WORD
from voxlake.functions.cleaning import ANY_BLANK, normalize_text

# U+10000 is a letter anyway; named outright it makes Java look back by characters, not half ones
WORD = "[\\p{L}\\p{N}_\U00010000]"
# A surrogate half is no character of its own; it shows as the replacement character.
HALF = "�"


@dataclass(frozen=True)
class SlangTerm:
    term: str
    replacement: str

    @property
    def is_word(self) -> bool:
        """Terms with a Latin letter or digit stand alone; others match anywhere."""
        return any(c.isascii() and c.isalnum() for c in self.term)

    @property
    def pattern(self) -> str:
        # The letters come first, then the look at both sides: Java finds plain letters fastest.
        quoted = r"\Q" + self.term.replace(r"\E", r"\E\\E\Q") + r"\E"
        return rf"{quoted}(?<!{WORD}{quoted})(?!{WORD})" if self.is_word else quoted

    @property
    def inserted(self) -> str:
        return " " + self.replacement.replace("\\", r"\\").replace("$", r"\$") + " "


def slang_terms(rows: Iterable[tuple] = SLANG) -> list[SlangTerm]:
    """Prepared terms, longest first; rows with a blank term or replacement are left out."""
    cleaned = [(str(row[0]).strip().lower(), str(row[1]).strip().lower()) for row in rows]
    kept = [SlangTerm(term, replacement) for term, replacement in cleaned if term and replacement]
    return sorted(kept, key=lambda entry: -len(entry.term))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once for a body that names it several times."""
    return F.transform(F.array(value), body)[0]


def decode_escapes(text: Column) -> Column:
    r"""Turn literal \uXXXX and \UXXXXXXXX into the characters they name, in one pass."""
    def character(token: Column) -> Column:
        digits = F.substring(token, 3, 8)
        code = F.conv(digits, 16, 10).cast("long")
        return (F.when(code > 0x10FFFF, token)
                .when(code.between(0xD800, 0xDFFF), F.lit(HALF))
                .otherwise(F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")))

    def decoded(raw: Column) -> Column:
        between = F.split(raw, ESCAPE)
        characters = F.transform(F.regexp_extract_all(raw, F.lit(ESCAPE), F.lit(0)), character)
        return F.array_join(F.zip_with(
            between, characters, lambda part, c: F.concat(part, F.coalesce(c, F.lit("")))), "")

    return _bind(text, lambda raw: F.when(
        F.contains(raw, F.lit("\\")), decoded(raw)).otherwise(raw))


def expand_stretched(text: Column) -> Column:
    """Follow each stretched word (a letter three times in a row) by its collapsed form."""
    word_edge = rf"(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD})"

    def expand(token: Column) -> Column:
        stretched = token.rlike(STRETCHED_WORD)
        collapsed = F.regexp_replace(token, STRETCH, "$1")
        return F.when(stretched, F.concat(token, F.lit(" "), collapsed)).otherwise(token)

    return _bind(text, lambda raw: F.when(
        raw.rlike(STRETCH), F.array_join(F.transform(F.split(raw, word_edge), expand), "")
    ).otherwise(raw))


def _one_of(terms: Iterable[str]) -> str:
    """Pattern for any of the terms, common beginnings written once, so that few are tried."""
    by_first: dict[str, list[str]] = {}
    for term in terms:
        by_first.setdefault(term[:1], []).append(term[1:])
    optional = "?" if by_first.pop("", None) else ""
    branches = [rf"\x{{{ord(first):x}}}{_one_of(rest)}" for first, rest in by_first.items()]
    return f"(?:{'|'.join(branches)}){optional}" if branches else ""


def _may_hold(text: Column, terms: list[SlangTerm]) -> Column:
    """False only where no term occurs."""
    words = [t.term for t in terms if t.is_word]
    others = [t.term for t in terms if not t.is_word]
    found = F.lit(False)
    if words:
        found = found | text.rlike(rf"(?<!{WORD}){_one_of(words)}(?!{WORD})")
    if others:
        # one range check per character is cheaper than the terms themselves
        lowest = min(ord(term[0]) for term in others)
        found = found | text.rlike(rf"[\x{{{lowest:x}}}-\x{{10ffff}}]")
    return found


def replace_terms(text: Column, terms: list[SlangTerm]) -> Column:
    """Apply the terms one after the other.

    A text without any term stays as it is after one look. In the others a term is only tried
    where its letters occur.
    """
    table = F.array(*[
        F.struct(F.lit(t.term).alias("term"), F.lit(t.pattern).alias("pattern"),
                 F.lit(t.inserted).alias("inserted")) for t in terms])

    def one_by_one(raw: Column) -> Column:
        return F.aggregate(table, raw, lambda acc, t: F.when(
            F.contains(acc, t["term"]), F.regexp_replace(acc, t["pattern"], t["inserted"])
        ).otherwise(acc))

    replaced = _bind(text, lambda raw: F.when(
        _may_hold(raw, terms), one_by_one(raw)).otherwise(raw))
    return F.trim(F.regexp_replace(replaced, ANY_BLANK, " "))


def apply_slang(text: Column, terms: list[SlangTerm]) -> Column:
    """Decode escapes, expand stretched words, replace slang. Without terms the text stays."""
    if not terms:
        return text
    return replace_terms(expand_stretched(decode_escapes(text)), terms)


def scoring_text(text: Column, terms: list[SlangTerm]) -> Column:
    r"""What a scorer reads: decoded, normalised, slang replaced.

    Decoding comes before lower-casing; the other way round breaks \U escapes.
    """
    return apply_slang(normalize_text(decode_escapes(text)), terms)


def evaluation_text(text: Column, terms: list[SlangTerm]) -> Column:
    """As scoring_text, but stretched words are expanded without a lexicon, too."""
    if terms:
        return scoring_text(text, terms)
    return expand_stretched(normalize_text(decode_escapes(text)))


def term_count(text: Column, term: SlangTerm) -> Column:
    """How often a term occurs as a word of its own."""
    return F.regexp_count(text, F.lit(term.pattern))
