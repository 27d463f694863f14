"""Name normalisation and the keys derived from normalised names."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.absent import strip

# Salt and hydrate words that do not tell two compounds apart.
SALT_WORDS = [
    "hydrochloride", "hcl", "sodium", "potassium", "sulfate", "sulphate", "phosphate",
    "maleate", "mesylate", "besylate", "tartrate", "citrate", "acetate", "fumarate",
    "succinate", "bromide", "chloride", "nitrate", "calcium", "dihydrate", "monohydrate",
    "hydrate", "anhydrous",
]


def _decompose(values: pa.Array) -> pa.Array:
    return pc.utf8_normalize(values, form="NFKD")


# Declared nondeterministic so that the optimiser runs it once where it stands, instead of again inside
# every filter and join condition on a value derived from it.
_nfkd = F.arrow_udf(_decompose, T.StringType()).asNondeterministic()


def normalize_name(c: Column) -> Column:
    """Decompose, drop accents, lower-case, punctuation to spaces, single spaces; NULL gives ''."""
    # Unicode decomposition is the one step Spark has no expression for.
    s = _nfkd(F.coalesce(c, F.lit("")))
    s = F.lower(F.regexp_replace(s, r"\p{InCombiningDiacriticalMarks}+", ""))
    s = F.regexp_replace(s, r"\p{Punct}", " ")
    return strip(F.regexp_replace(s, r"\s+", " "))


def drop_salts(normalized: Column) -> Column:
    """Remove salt words anywhere in a normalised name, unless nothing would be left."""
    tokens = F.split(normalized, " ")
    kept = F.filter(tokens, lambda t: ~t.isin(SALT_WORDS))
    return F.when(F.size(kept) == 0, normalized).otherwise(F.array_join(kept, " "))


def strip_salts(c: Column) -> Column:
    return drop_salts(normalize_name(c))


def name_prefix(stripped: Column, n: int = 6) -> Column:
    """First `n` characters of a salt-free name without its spaces."""
    return F.substring(F.replace(stripped, F.lit(" "), F.lit("")), 1, n)


def blocking_key(c: Column, n: int = 6) -> Column:
    return name_prefix(strip_salts(c), n)


def inchikey_skeleton(c: Column) -> Column:
    """First 14 characters of a trimmed InChIKey; NULL when it is shorter."""
    t = strip(c)
    return F.when(F.length(t) >= 14, F.substring(t, 1, 14))


def token_set(normalized: Column) -> Column:
    """Distinct non-empty tokens of a normalised name."""
    return F.array_distinct(F.filter(F.split(normalized, " "), lambda t: t != ""))


def is_valid_cas(c: Column) -> Column:
    """Check digit of a CAS number: 5 to 10 digits, weights counted from the right. NULL is invalid."""
    d = F.regexp_replace(c, "[^0-9]", "")
    n = F.length(d)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + F.substring(d, n - i, 1).try_cast("int") * i,
    )
    ok = F.when(n.between(5, 10), total % 10 == F.substring(d, n, 1).try_cast("int"))
    return F.coalesce(ok, F.lit(False))


def edge_ngrams(token: Column, shortest: int = 2, longest: int = 20) -> Column:
    """Prefixes of a token from `shortest` to `longest` characters; empty for shorter tokens."""
    n = F.length(token)
    grams = F.transform(
        F.sequence(F.lit(shortest), F.greatest(F.least(F.lit(longest), n), F.lit(shortest))),
        lambda i: F.substring(token, F.lit(1), i),
    )
    return F.when(n >= shortest, grams).otherwise(F.array().cast("array<string>"))
