"""Cleaning, splitting and judging text: Column to Column, parameterised by the script."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Preset:
    """What belongs to a script: letters as the inside of a character class, sentence ends, punctuation, bounds."""

    letters: str
    enders: str
    keep: str
    edge: str
    sentence: tuple[int, int]
    word: tuple[int, int]
    least_share: float = 0.6


#: Code point ranges, punctuation and bounds of the Han preset.
HAN = Preset(
    letters=r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}",
    enders="。！？!?；;\n",
    keep="，、。！？：；「」『』（）,.!?:;()《》〈〉—…·～~%",
    edge="，、：；,.;: ",
    sentence=(4, 25),
    word=(2, 4),
)
LATIN = Preset(letters="A-Za-zÀ-ÖØ-öø-ÿ", enders=".!?;\n", keep=" ,.!?:;()'-", edge=",:; .", sentence=(20, 120), word=(2, 12))


def _class(chars: str) -> str:
    return "".join("\\" + c if c in r"\]^-[&" else c for c in chars)


def chars(c: Column) -> Column:
    """The characters of c in order; none of an empty text."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def is_letter(c: Column, preset: Preset) -> Column:
    return c.rlike(f"^[{preset.letters}]$")


def clean_text(c: Column, newlines: str = "glue") -> Column:
    """Wide and no-break spaces to spaces; control characters, [n] marks and URLs deleted; white space collapsed and trimmed.

    newlines: "glue" deletes them like other control characters, "split" keeps them for splitting.
    """
    c = F.translate(c, "　 ", "  ")
    c = F.regexp_replace(c, r"[\x00-\x1f\x7f]" if newlines == "glue" else r"[\x00-\x09\x0b-\x1f\x7f]", "")
    c = F.regexp_replace(c, r"(?U)\[\d+\]", "")
    c = F.regexp_replace(c, r"(?U)https?://\S+", "")
    c = F.regexp_replace(c, r"(?U)\s+" if newlines == "glue" else r"(?U)[^\S\n]+", " ")
    return F.trim(c)


def keep_allowed(c: Column, preset: Preset) -> Column:
    """Letters and kept punctuation alone, without punctuation at the edges."""
    c = F.regexp_replace(c, f"[^{preset.letters}{_class(preset.keep)}]", "")
    return F.btrim(c, F.lit(preset.edge))


def split_sentences(c: Column, preset: Preset) -> Column:
    return F.split(c, f"[{_class(preset.enders)}]", -1)


def length_in(c: Column, bounds: tuple[int, int]) -> Column:
    return F.length(c).between(*bounds)


def letter_share(c: Column, preset: Preset) -> Column:
    return F.length(F.regexp_replace(c, f"[^{preset.letters}]", "")) / F.greatest(F.lit(1), F.length(c))


def no_run(c: Column, n: int = 5) -> Column:
    return ~c.rlike(rf"(?s)(.)\1{{{n - 1},}}")


def no_digits(c: Column, n: int = 6) -> Column:
    return ~c.rlike(rf"(?U)\d{{{n},}}")


def no_markup(c: Column) -> Column:
    return ~c.rlike(r"[{}\[\]|=<>]")


def acceptable(c: Column, preset: Preset, need: list[str] | None = None) -> Column:
    """All predicates at once; need: at least one of these characters."""
    ok = length_in(c, preset.sentence) & (letter_share(c, preset) >= preset.least_share) & no_run(c) & no_digits(c) & no_markup(c)
    return ok & c.rlike(f"[{_class(''.join(need))}]") if need else ok


def reject_reason(c: Column, preset: Preset) -> Column:
    """The first predicate that c fails, or null."""
    return (
        F.when(~length_in(c, preset.sentence), "length")
        .when(letter_share(c, preset) < preset.least_share, "letters")
        .when(~no_run(c), "run")
        .when(~no_digits(c), "digits")
        .when(~no_markup(c), "markup")
    )


def word_entry(c: Column, preset: Preset) -> Column:
    """Words: length within bounds, letters alone."""
    return length_in(c, preset.word) & c.rlike(f"^[{preset.letters}]+$")


def plane(c: Column) -> Column:
    """Block of the first character. Fixed ranges: BMP, ExtA, ExtB+ (anything from U+20000), Compat; else other."""
    o = F.ascii(c)
    return (
        F.when(o.between(0x4E00, 0x9FFF), "BMP").when(o.between(0x3400, 0x4DBF), "ExtA").when(o >= 0x20000, "ExtB+").when(o.between(0xF900, 0xFAFF), "Compat").otherwise("other")
    )


def code_point(c: Column) -> Column:
    return F.format_string("U+%05X", F.ascii(c))


def file_name(tier: Column, index: Column) -> Column:
    return F.format_string("%s_%06d.jpg", tier, index)


def font_key(family: Column, index: Column, variation: Column) -> Column:
    """family[#index][@variation], zero and null left out."""
    part = lambda mark, c: F.when(F.coalesce(c, F.lit(0)) != 0, F.concat(F.lit(mark), c.cast("string"))).otherwise("")
    return F.concat(family, part("#", index), part("@", variation))


def stem(c: Column) -> Column:
    return F.translate(F.lower(c), "-_", "")


def in_set(c: Column, members: Column) -> Column:
    """Characters of c that are in the array members, in order, with repeats."""
    return F.filter(chars(c), lambda x: F.array_contains(members, x))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def highlight(c: Column, members: list[str], before: str = "<b>", after: str = "</b>") -> Column:
    return F.regexp_replace(c, f"([{_class(''.join(members))}])", f"{before}$1{after}")


def percent(c: Column, as_percent: bool = False) -> Column:
    return F.when(c.isNull(), "TBD").otherwise(F.format_string("%.1f%%", c * 100) if as_percent else F.format_string("%.4f", c))


def human_bytes(c: Column) -> Column:
    """A number of bytes with one digit in B to TB, halves to even.

    Only the fraction is rounded, so that a half is one of the binary value, not of the digits it is shown by.
    """

    def of(power: int, unit: str) -> Column:
        v = c.cast("double") / F.lit(float(1024**power))
        whole = F.floor(v).cast("double")
        # from 2**52 on a double has no fraction, and further on its floor no long
        return F.format_string(f"%.1f {unit}", F.when(v < float(1 << 52), whole + F.rint((v - whole) * 10) / 10).otherwise(v))

    text = of(4, "TB")
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        text = F.when(c < 1024 ** (power + 1), of(power, unit)).otherwise(text)
    return F.when(c.isNotNull(), text)
