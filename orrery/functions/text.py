"""Column expressions for tokens and stems, plus their SQL twins.

Tokeniser: lower-case, then every match of ``TOKEN_PATTERN`` in the whole
text (a leading apostrophe stays with the following word, so "father's"
gives "father", "'s"); tokens in the stop-word list or without a letter are
dropped.

Stemmer: the published Snowball English algorithm ("Porter 2"). Each step looks
up the longest of its endings once (a pattern anchored at the end finds the
leftmost start, which is the longest ending), and the regions R1 and R2, behind
the first and the second vowel-consonant pair, are measured once per token. The
steps are SQL expressions that mean the same in Spark and DuckDB, each over the
columns of the step before, so no expression is nested in another.
"""

from __future__ import annotations

import functools
from importlib import resources

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
TOKEN_PATTERN = "'?[\\p{L}0-9]+"
LETTER_PATTERN = "\\p{L}"
# Sentences: a final mark, closing marks and a gap end one, but not behind an
# abbreviation or an initial, a number that opens a line, or before a small letter.
SENTENCE_MARK = "\x1e"  # a record separator in a text is a possible end, too
GAP = "[ \\t\\n\\r\\f]"
SENTENCE_END = "[.!?\u2026][\"'\u201d\u2019\u00bb)\\]]*" + GAP + "+"
SMALL_START = "([\"'\u201c\u2018\u00ab(\\[]*\\p{Ll})"
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "St", "Rev", "Hon", "Gen", "Col", "Lt", "Sgt", "Capt", "Gov", "Sen", "Rep",
                 "Inc", "Ltd", "Co", "Corp", "vs", "etc", "No", "Nr", "Fig", "Vol", "pp", "cf", "al", "Mt", "Ave", "Bd", "Hr", "Fr", "Sra", "Dra")
# The published algorithm's lists: words with stems of their own, words that
# stay, words that stay after step 1a, beginnings that set R1, doubles, letters
# before a removable -li, endings of the steps with what replaces them.
OWN_STEMS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
             "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
UNCHANGED = ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")
UNCHANGED_AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
R1_PREFIXES = ("gener", "commun", "arsen")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_LETTERS = "cdeghkmnrt"
STEP_2 = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate",
          "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous",
          "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": ""}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")
# --------------------------------------------------------------------------
_V, _C = "[aeiouy]", "[^aeiouy]"
_SHORT = f"({_C}{_V}[^aeiouywxY]|^{_V}{_C})$"  # a short syllable at the end


def _found(text: str, pattern: str) -> str:
    return f"regexp_extract({text}, '{pattern}', 0)"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _ending(endings) -> str:
    """The longest of the endings that w has, or an empty text."""
    return _found("w", "(" + "|".join(sorted(endings, key=lambda e: (-len(e), e))) + ")$")


def _swap(endings: dict, special: dict | None = None) -> str:
    """w with its ending e (in R1) replaced; ``special`` endings ask for more."""
    cases = [f"WHEN e = '{e}' THEN CASE WHEN {ask} THEN b || '{endings[e]}' ELSE w END" for e, ask in (special or {}).items()]
    plain = {}
    for e, new in endings.items():
        if e not in (special or {}):
            plain.setdefault(new, []).append(e)
    cases += [f"WHEN e IN {_in(es)} THEN b || '{new}'" for new, es in plain.items()]
    return f"CASE WHEN e = '' OR length(b) < p1 THEN w {' '.join(cases)} ELSE w END"


_REST = "substr(w, 1, length(w) - length(e))"


def stem_steps(token: str = "token") -> list[dict[str, str]]:
    """The steps, in order: each names new columns by expressions of the last
    ones. w is the word so far, e the ending of the step, b what is before it,
    p1 and p2 where R1 and R2 begin; ``stem`` comes last."""
    def region(text, start="0"):
        pair = f"{start} + length({_found(text, f'^{_C}*{_V}+{_C}')})"
        return f"CASE WHEN {_found(text, f'{_V}{_C}')} = '' THEN length(w) ELSE {pair} END"

    own = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in OWN_STEMS.items())
    marked = "w"
    for pair in ("ay", "ey", "iy", "oy", "uy", "yy"):
        marked = f"replace({marked}, '{pair}', '{pair[0]}Y')"
    starts = " ".join(f"WHEN w LIKE '{p}%' THEN {len(p)}" for p in R1_PREFIXES)
    undone = f"CASE WHEN right(b, 2) IN ('at', 'bl', 'iz') THEN b || 'e' WHEN right(b, 2) IN {_in(DOUBLES)} THEN substr(b, 1, length(b) - 1) " \
             f"WHEN length(b) <= p1 AND {_found('b', _SHORT)} <> '' THEN b || 'e' ELSE b END"
    return [
        {"own": f"CASE {token} {own} ELSE CASE WHEN length({token}) <= 2 OR {token} IN {_in(UNCHANGED)} THEN {token} END END",
         "w": f"CASE WHEN left({token}, 1) = chr(39) THEN substr({token}, 2) ELSE {token} END"},
        {"w": "CASE WHEN w LIKE 'y%' THEN 'Y' || substr(w, 2) ELSE w END"},
        {"w": marked},
        {"p1": f"CASE {starts} ELSE {region('w')} END"},
        {"p2": region("substr(w, p1 + 1)", "p1"), "e": "regexp_extract(w, replace('(#s#|#s|#)$', '#', chr(39)), 0)"},  # step 0
        {"w": _REST},
        {"e": _ending(("sses", "ied", "ies", "us", "ss", "s"))},  # step 1a
        {"w": "CASE WHEN e = 'sses' THEN substr(w, 1, length(w) - 2) "
              "WHEN e IN ('ied', 'ies') THEN substr(w, 1, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END) "
              f"WHEN e = 's' AND {_found('substr(w, 1, length(w) - 2)', _V)} <> '' THEN substr(w, 1, length(w) - 1) ELSE w END"},
        {"own": f"CASE WHEN own IS NULL AND w IN {_in(UNCHANGED_AFTER_1A)} THEN w ELSE own END",
         "e": _ending(("eed", "eedly", "ed", "edly", "ing", "ingly"))},  # step 1b
        {"b": _REST},
        {"w": f"CASE WHEN e IN ('eed', 'eedly') THEN CASE WHEN length(b) >= p1 THEN b || 'ee' ELSE w END "
              f"WHEN e <> '' AND {_found('b', _V)} <> '' THEN {undone} ELSE w END"},
        {"w": f"CASE WHEN {_found('w', f'.{_C}[yY]$')} <> '' THEN substr(w, 1, length(w) - 1) || 'i' ELSE w END"},  # step 1c
        {"e": _ending(STEP_2)}, {"b": _REST},
        {"w": _swap(STEP_2, {"ogi": "right(b, 1) = 'l'", "li": f"{_found('b', f'[{LI_LETTERS}]$')} <> ''"})},
        {"e": _ending(STEP_3)}, {"b": _REST},
        {"w": _swap(STEP_3, {"ative": "length(b) >= p2"})},
        {"e": _ending(STEP_4)}, {"b": _REST},
        {"w": "CASE WHEN e = '' OR length(b) < p2 OR e = 'ion' AND right(b, 1) NOT IN ('s', 't') THEN w ELSE b END"},
        {"b": "substr(w, 1, length(w) - 1)", "e": "right(w, 1)"},  # step 5
        {"w": f"CASE WHEN e = 'e' AND (length(b) >= p2 OR length(b) >= p1 AND {_found('b', _SHORT)} = '') "
              "OR e = 'l' AND length(b) >= p2 AND right(b, 1) = 'l' THEN b ELSE w END"},
        {"stem": "coalesce(own, replace(w, 'Y', 'y'))"},
    ]


@functools.lru_cache(maxsize=None)
def stopwords(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop words, kept as a text file of the package:
    neither a JVM nor a jar is needed to build queries or SQL text."""
    text = resources.files(__package__).joinpath(f"stopwords_{language}.txt").read_text("utf-8")
    return tuple(w for w in text.split("\n") if w)


def token_array(text_col, case_sensitive_stopwords: bool = False):
    """Filtered token array of a text column (T1–T3), fully JVM-side.

    The stop-word test is an ``IN`` list that Catalyst turns into a hash set.
    With ``case_sensitive_stopwords`` the test runs before lower-casing, as
    the original notebook did (ledger Q22).
    """
    stop = list(stopwords())
    if case_sensitive_stopwords:
        raw = F.regexp_extract_all(text_col, F.lit(TOKEN_PATTERN), 0)
        kept = F.filter(raw, lambda t: ~t.isin(*stop))
        return F.filter(F.transform(kept, lambda t: F.lower(t)), lambda t: t.rlike(LETTER_PATTERN))
    toks = F.regexp_extract_all(F.lower(text_col), F.lit(TOKEN_PATTERN), 0)
    return F.filter(toks, lambda t: (~t.isin(*stop)) & t.rlike(LETTER_PATTERN))


def with_stem(words: DataFrame, token: str = "token") -> DataFrame:
    """``words`` with the column ``stem`` of its column ``token`` (T4). Each
    step is a projection of its own, so that no step is worked out twice. Cut
    the lineage before filtering on the stem: a filter pushed down through the
    steps would unfold them into one another."""
    out, kept = words, words.columns
    for step in stem_steps(token):
        out = out.select(*[c for c in out.columns if c not in step], *[F.expr(x).alias(c) for c, x in step.items()])
    return out.select(*kept, "stem")


def sql_stems(words: str, token: str = "token") -> str:
    """SQL: ``token`` and ``stem`` of the rows of the query ``words``."""
    out, have = words, [token]
    for step in stem_steps(token):
        have = [c for c in have if c not in step]
        out = f"SELECT {', '.join(have + [f'{x} AS {c}' for c, x in step.items()])} FROM ({out}) s_"
        have += step
    return f"SELECT {token}, stem FROM ({out}) s_"


def sentence_rules() -> list[tuple[str, str]]:
    """(pattern, what it becomes) in order; {0} is the whole match, {1} the
    group. The first rule puts a mark behind every possible end, the others
    take marks away; the rule for initials goes twice, as neighbouring ones
    share a character."""
    short = "((?:^|[^\\p{L}])(?:" + "|".join(ABBREVIATIONS) + "|\\p{Lu})\\." + GAP + "+)" + SENTENCE_MARK
    listed = "((?:^|\\n|" + SENTENCE_MARK + ")[ \\t]*[0-9]+\\." + GAP + "+)" + SENTENCE_MARK
    return [(SENTENCE_END, "{0}" + SENTENCE_MARK), (SENTENCE_MARK + SMALL_START, "{1}"), (short, "{1}"), (short, "{1}"), (listed, "{1}")]


def sentence_array(text_col):
    """The sentences of a text, gaps included: put together they are the text
    without record separators (T1). Empty ones are left out."""
    out = text_col
    for pattern, new in sentence_rules():
        out = F.regexp_replace(out, pattern, new.replace("{0}", "$0").replace("{1}", "$1"))
    return F.filter(F.split(out, SENTENCE_MARK, -1), lambda x: x != "")


def sql_sentence_list(text: str) -> str:
    """SQL: the list of the sentences."""
    out = text
    for pattern, new in sentence_rules():
        new = new.replace("{0}", "\\0").replace("{1}", "\\1")
        out = "regexp_replace({}, '{}', '{}', 'g')".format(out, pattern.replace("'", "''"), new)
    return f"list_filter(string_split({out}, '{SENTENCE_MARK}'), lambda x: x <> '')"


def sql_stopword_values() -> str:
    """``(VALUES ('a'), ...)`` list of stop words for SQL text."""
    return ", ".join("('" + w.replace("'", "''") + "')" for w in stopwords())
