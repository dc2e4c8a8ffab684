"""Porter (1980) suffix stripping as column expressions over a word table.

Beside each word ``w`` runs its shape ``p``, one letter C or V a character.  A
character's class depends only on what is before it, and no suffix that is put
on holds a ``y``, so a step that cuts ``k`` characters and appends ``a`` does the
same to the shape.  Every step is then a choice of (cut, append), and the
measure of a stem is a regular expression on its shape.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suffixes of the published rules and what replaces them.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
         "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
         "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
         "biliti": "ble", "logi": "log"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
         "ate", "iti", "ous", "ive", "ize"]

_MORE_THAN_0, _MORE_THAN_1, _EXACTLY_1 = "^C*V+C", "^C*V+C+V+C", "^C*V+C+V*$"


def shape(w: Column) -> Column:
    """C or V for each character; ``y`` is V after a C, otherwise C, so a run of
    y alternates: pairs that start after a V (or the start) are CV, pairs that
    start after a C are VC, and what is left is a single y."""
    p = F.regexp_replace(F.regexp_replace(w, "[^aeiouy]", "C"), "[aeiou]", "V")
    p = F.regexp_replace(p, "(?:(?<=^|V)|\\G(?!^))yy", "CV")
    p = F.regexp_replace(p, "(?:(?<=C)|\\G(?!^))yy", "VC")
    return F.regexp_replace(F.regexp_replace(p, "(?<=^|V)y", "C"), "(?<=C)y", "V")


def _stem_shape(cut: int) -> Column:
    return F.expr(f"left(p, length(p) - {cut})")


def _ends(*suffixes: str) -> Column:
    return reduce(or_, (F.col("w").endswith(x) for x in suffixes))


def _double() -> Column:
    return (F.length("w") >= 2) & (F.expr("right(w, 1)") == F.expr("substring(w, -2, 1)")) & F.col("p").endswith("C")


def _short(shape_: Column, last: Column) -> Column:
    return shape_.endswith("CVC") & ~last.isin("w", "x", "y")


def _step(words: DataFrame, rules: list[tuple[Column, int, str]], *flags: Column) -> DataFrame:
    """The first rule whose condition holds: cut, then append."""
    cut, add = F.lit(0), F.lit("")
    for cond, k, a in reversed(rules):
        cut, add = F.when(cond, k).otherwise(cut), F.when(cond, F.lit(a)).otherwise(add)
    # cut and append are computed once; the next select only applies them
    d = words.select("word", "w", "p", cut.alias("k"), add.alias("a"), *flags)
    kept = [f"_{i}" for i in range(len(flags))]
    return d.select("word", F.expr("left(w, length(w) - k) || a").alias("w"),
                    F.expr("left(p, length(p) - k) || regexp_replace(regexp_replace(a, '[^aeiou]', 'C'), '[aeiou]', 'V')").alias("p"), *kept)


def _by_suffix(replace: dict[str, str], condition) -> list[tuple[Column, int, str]]:
    """Only the longest suffix that fits is tried."""
    rules = []
    for suf in sorted(replace, key=len, reverse=True):
        rules.append((_ends(suf) & condition(suf), len(suf), replace[suf]))
        rules.append((_ends(suf), 0, ""))
    return rules


def stem_table(vocab: DataFrame) -> DataFrame:
    """(word, stem) of a table with a column ``word``: lower case, words of one
    or two characters unchanged, a null word null."""
    some = lambda cut: _stem_shape(cut).rlike(_MORE_THAN_0)
    many = lambda cut: _stem_shape(cut).rlike(_MORE_THAN_1)
    vowel = lambda cut: _stem_shape(cut).contains("V")        # noqa: E731
    d = vocab.select("word", F.lower("word").alias("w"))
    d = d.select("word", "w", shape(F.col("w")).alias("p"))
    # 1a plurals
    d = _step(d, [(_ends("sses", "ies"), 2, ""), (_ends("ss"), 0, ""), (_ends("s"), 1, "")])
    # 1b past forms; a cut form is mended by the next step
    ed, ing = ~_ends("eed") & _ends("ed") & vowel(2), _ends("ing") & vowel(3)
    d = _step(d, [(_ends("eed") & some(3), 1, ""), (_ends("eed"), 0, ""), (ed, 2, ""), (ing, 3, "")], (ed | ing).alias("_0"))
    mend, last = F.col("_0"), F.expr("right(w, 1)")
    d = _step(d, [(mend & _ends("at", "bl", "iz"), 0, "e"), (mend & _double() & ~last.isin("l", "s", "z"), 1, ""),
                  (mend & ~_double() & F.col("p").rlike(_EXACTLY_1) & _short(F.col("p"), last), 0, "e")])
    # 1c
    d = _step(d, [(_ends("y") & vowel(1), 1, "i")])
    # 2, 3, 4
    d = _step(d, _by_suffix(STEP2, lambda suf: some(len(suf))))
    d = _step(d, _by_suffix(STEP3, lambda suf: some(len(suf))))
    d = _step(d, _by_suffix({suf: "" for suf in STEP4}, lambda suf: many(len(suf)) & (_ends("sion", "tion") if suf == "ion" else F.lit(True))))
    # 5
    bare = _stem_shape(1)
    d = _step(d, [(_ends("e") & (bare.rlike(_MORE_THAN_1) | (bare.rlike(_EXACTLY_1) & ~_short(bare, F.expr("substring(w, -2, 1)")))), 1, "")])
    d = _step(d, [(_double() & _ends("l") & F.col("p").rlike(_MORE_THAN_1), 1, "")])
    return d.select("word", F.when(F.length("word") <= 2, F.lower("word")).otherwise(F.col("w")).alias("stem"))
