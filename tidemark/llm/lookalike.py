"""One consistent form for text that reads the same but is written with different characters.

The form: default-ignorable characters removed, every blank mapped to the plain one (runs to one, none at the
ends), compatibility composition (NFKC), look-alike letters of other scripts inside Latin words mapped to the
Latin ones, full case folding, composed again. ``changes`` says which of these the value needed.

Values of plain ASCII never leave the JVM. The others are worked on once per distinct value of a batch.
Null stays null, an empty or blank value becomes the empty string.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.session import arrow

#: Bits of ``changes``.
WIDE, JOINED, INVISIBLE, BLANK, ACCENT, MIXED = 1, 2, 4, 8, 16, 32

#: The Default_Ignorable_Code_Point ranges of Unicode.
IGNORABLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
#: Blanks that are neither the plain one nor line breaks.
BLANKS = "\t\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
#: Combining accents, without the marks that other scripts are written with.
ACCENTS = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff"
#: Letters, script by script, beside the Latin letters they look like.
_ALIKE = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТХУԌԚԜаеѕіјорсухһԁԛԝѵкмнвтьг", "ABESIJKMHOPCTXYGQWaesijopcyxhdqwvkmhbtbr"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳανικορυχγητωεμσςβϲ", "ABEZHIKMNOPTYXCjavikopuxyntweuosbc"),
    "Armenian": ("ՏՕՍԼօոսզհցքռյա", "SOULonuqhgfnjw"),
    "Coptic": ("ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲁⲃⲉⲏⲓⲕⲙⲛⲟⲣⲥⲧⲩⲭ", "ABEHIKMNOPCTYXabehikmnopctyx"),
    "Cherokee": ("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiYAJEWMHYGhZbRWSVSLCPKdGB"),
    "Lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "Latin": ("ɑɡɩʋᴀᴄᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀᴛᴜᴠᴡʏᴢ", "agivaceghijklmnoprtuvwyz"),
}
CONFUSABLE = {a: b for alike, latin in _ALIKE.values() for a, b in zip(alike, latin, strict=True)}

_alike = regex.compile(f"[{''.join(CONFUSABLE)}]")
_special = regex.compile(rf"[^\x20-\x7e\n\r]")
_ignorable = regex.compile(f"[{IGNORABLE}]+")
_blank = regex.compile(f"[{BLANKS}]")
_wide = regex.compile("[！-～￠-￦]")
_accent = regex.compile(rf"\p{{L}}[{ACCENTS}]")
_other = r"[\p{Greek}\p{Cyrillic}\p{Armenian}\p{Cherokee}\p{Coptic}\p{Georgian}\p{Lisu}]"
_mixed = regex.compile(rf"(?V1)(?:[\p{{Latin}}&&\p{{L}}][\p{{L}}\p{{M}}\p{{N}}_]*{_other}|{_other}[\p{{L}}\p{{M}}\p{{N}}_]*[\p{{Latin}}&&\p{{L}}])")
_word = regex.compile(r"[\p{L}\p{M}\p{N}_]+")
_latin = regex.compile(r"(?V1)[\p{Latin}&&\p{L}]")
_joined_seen: dict[str, bool] = {}


def _joined(ch: str) -> bool:
    """A single letter that stands for several joined ones (ligatures, digraphs)."""
    if ch not in _joined_seen:
        kind, _, rest = unicodedata.decomposition(ch).partition(" ")
        parts = [chr(int(x, 16)) for x in rest.split()] if kind == "<compat>" else []
        _joined_seen[ch] = len(parts) > 1 and unicodedata.category(ch)[0] == "L" and all(unicodedata.category(p)[0] == "L" for p in parts)
    return _joined_seen[ch]


def _to_latin(match) -> str:
    word = match.group()
    return "".join(CONFUSABLE.get(c, c) for c in word) if _latin.search(word) else word


def consistent(value: str) -> tuple[str, int]:
    """The consistent form of one value, and the bits of what had to change."""
    if not _special.search(value):
        return " ".join(value.split()).casefold(), 0
    changes = 0
    clean = _ignorable.sub("", value)
    if clean != value:
        changes |= INVISIBLE
    if _blank.search(clean):
        changes |= BLANK
    if _wide.search(clean):
        changes |= WIDE
    if any(_joined(c) for c in set(clean) if c > "\x7f"):
        changes |= JOINED
    if _accent.search(clean):
        changes |= ACCENT
    composed = unicodedata.normalize("NFKC", clean)
    if _mixed.search(composed):
        changes |= MIXED
    if _alike.search(composed):
        composed = _word.sub(_to_latin, composed)  # phonetic letters are Latin themselves: they are mapped, but mix no scripts
    return " ".join(unicodedata.normalize("NFKC", composed.casefold()).split()), changes


RESULT = StructType([StructField("form", StringType()), StructField("changes", IntegerType())])


def _hard(value: Column) -> Column:
    @arrow(RESULT)
    def forms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            coded = batch.dictionary_encode()
            done = [consistent(v) for v in coded.dictionary.to_pylist()]
            table = pa.StructArray.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32())], ["form", "changes"])
            yield table.take(coded.indices)

    return forms(value)


def needs_work(value: Column) -> Column:
    """False for values that plain lower-casing and joining of blanks settle."""
    return value.rlike(r"[^\x20-\x7e\n\r]")


def consistent_form(value: Column | str) -> Column:
    """struct<form, changes> of a text column; null for null."""
    value = F.col(value) if isinstance(value, str) else value
    hard = _hard(F.when(needs_work(value), value))
    plain = F.struct(F.lower(F.trim(F.regexp_replace(value, r"\s+", " "))).alias("form"), F.lit(0).alias("changes"))
    return F.when(value.isNull(), F.lit(None).cast(RESULT)).when(needs_work(value), hard).otherwise(plain)
