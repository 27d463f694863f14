"""Metaphone (Lawrence Philips, 1990) as a chain of ordered replacements on upper-case letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (pattern, replacement) in the order they apply. Sounds already settled are written in
# lower case (0 stands for th), so later rules leave them alone.
RULES = [
    (r"^(AE|GN|KN|PN|WR)", "#$1"),
    (r"^#.", ""),
    (r"^X", "S"),
    (r"^WH", "W"),
    (r"MB$", "M"),
    (r"TCH", "CH"),
    (r"SCH", "sk"),
    (r"CIA", "xIA"),
    (r"CH", "x"),
    (r"SC([IEY])", "s$1"),
    (r"C([IEY])", "s$1"),
    (r"CK", "k"),
    (r"C", "k"),
    (r"DG([EIY])", "j$1"),
    (r"D", "t"),
    (r"GH([^AEIOU])", "$1"),
    (r"GH", "k"),
    (r"GN(ED)?$", "n$1"),
    (r"G([EIY])", "j$1"),
    (r"G", "k"),
    (r"PH", "f"),
    (r"SH", "x"),
    (r"SI([OA])", "x$1"),
    (r"TI([OA])", "x$1"),
    (r"TH", "0"),
    (r"([AEIOU])H([^AEIOU]|$)", "$1$2"),
    (r"W([^AEIOU]|$)", "$1"),
    (r"Y([^AEIOU]|$)", "$1"),
    (r"X", "ks"),
]
SAME_SOUND = ("QVZ", "kfs")
LONGEST = 4


def metaphone(word: Column) -> Column:
    """Sound code of a word, at most four letters; NULL when the word has no letter of A to Z."""
    code = F.regexp_replace(F.upper(word), r"[^A-Z]", "")
    # Doubled letters sound once, except C.
    code = F.regexp_replace(code, r"([ABD-Z])\1+", "$1")
    for pattern, replacement in RULES:
        code = F.regexp_replace(code, pattern, replacement)
    # Vowels count only at the start.
    rest = F.regexp_replace(F.substring(code, F.lit(2), F.length(code)), "[AEIOU]", "")
    code = F.upper(F.translate(F.concat(F.substring(code, 1, 1), rest), *SAME_SOUND))
    return F.nullif(F.substring(code, 1, LONGEST), F.lit(""))
