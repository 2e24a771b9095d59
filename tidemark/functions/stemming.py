"""Portuguese stems by the published suffix-stripping algorithm (Snowball), as column expressions over rule tables.

A word has three regions: R1 begins after the first consonant that follows a vowel, R2 after the next such place in R1, and RV
depends on the first letters. Each step looks for the longest suffix of its table and acts if the suffix lies in the region that
the table names. ``ã`` and ``õ`` are handled as a vowel and a consonant mark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, tokens

# Fixed values of the published algorithm, in its order.
VOWELS = "aeiouáéíóúâêô"
#: Deleted in R2.
NOUNS = (
    "eza", "ezas", "ico", "ica", "icos", "icas", "ismo", "ismos", "ável", "ível", "ista", "istas", "oso", "osa", "osos", "osas", "amento", "amentos",
    "imento", "imentos", "adora", "ador", "aça~o", "adoras", "adores", "aço~es", "ante", "antes", "ância",
)
#: Replaced in R2.
REPLACED = {"logia": "log", "logias": "log", "uça~o": "u", "uço~es": "u", "ência": "ente", "ências": "ente"}
#: Deleted in R2 with what may stand before them.
BEFORE = {
    "mente": "ante|avel|ível", "idade": "abil|ic|iv", "idades": "abil|ic|iv", "iva": "at", "ivo": "at", "ivas": "at", "ivos": "at",
}
#: Deleted in RV where no noun suffix was.
VERBS = (
    "ada", "ida", "ia", "aria", "eria", "iria", "ará", "ara", "erá", "era", "irá", "ava", "asse", "esse", "isse", "aste", "este", "iste", "ei", "arei", "erei",
    "irei", "am", "iam", "ariam", "eriam", "iriam", "aram", "eram", "iram", "avam", "em", "arem", "erem", "irem", "assem", "essem", "issem", "ado", "ido",
    "ando", "endo", "indo", "ara~o", "era~o", "ira~o", "ar", "er", "ir", "as", "adas", "idas", "ias", "arias", "erias", "irias", "arás", "aras", "erás", "eras",
    "irás", "avas", "es", "ardes", "erdes", "irdes", "ares", "eres", "ires", "asses", "esses", "isses", "astes", "estes", "istes", "is", "ais", "eis", "íeis",
    "aríeis", "eríeis", "iríeis", "áreis", "areis", "éreis", "ereis", "íreis", "ireis", "ásseis", "ésseis", "ísseis", "áveis", "ados", "idos", "ámos", "amos",
    "íamos", "aríamos", "eríamos", "iríamos", "áramos", "éramos", "íramos", "ávamos", "emos", "aremos", "eremos", "iremos", "ássemos", "êssemos", "íssemos",
    "imos", "armos", "ermos", "irmos", "eu", "iu", "ou", "ira", "iras",
)
#: Deleted in RV where nothing else was.
RESIDUAL = ("os", "a", "i", "o", "á", "í", "ó")
#: Words that are no terms.
STOP_WORDS = (
    "de", "a", "o", "que", "e", "do", "da", "em", "um", "para", "com", "não", "uma", "os", "no", "se", "na", "por", "mais", "as", "dos", "como", "mas", "ao",
    "ele", "das", "à", "seu", "sua", "ou", "quando", "muito", "nos", "já", "eu", "também", "só", "pelo", "pela", "até", "isso", "ela", "entre", "depois", "sem",
    "mesmo", "aos", "seus", "quem", "nas", "me", "esse", "eles", "você", "essa", "num", "nem", "suas", "meu", "às", "minha", "numa", "pelos", "elas", "qual",
    "nós", "lhe", "deles", "essas", "esses", "pelas", "este", "dele", "tu", "te", "vocês", "vos", "lhes", "meus", "minhas", "teu", "tua", "teus", "tuas",
    "nosso", "nossa", "nossos", "nossas", "dela", "delas", "esta", "estes", "estas", "aquele", "aquela", "aqueles", "aquelas", "isto", "aquilo", "foi", "tem",
    "ser", "há", "está", "era", "ter", "estão", "tinha", "foram", "têm", "havia", "seja", "será", "tenho", "fosse", "é",
)

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"
#: What stands before R1 (in R1: before R2), and before RV for words that begin with a letter and a consonant, two vowels, or a consonant and a vowel.
BEFORE_R1 = f"^.*?{_V}{_C}"
BEFORE_RV = f"^(?:.{_C}+{_V}|{_V}{_V}+{_C}|{_C}{_V}.)"


def longest(suffixes) -> str:
    """A pattern that finds the longest of some suffixes: the match that begins first."""
    return f"(?:{'|'.join(suffixes)})$"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _region(word: Column, before: str) -> Column:
    """What follows the first match of ``before``; nothing where it doesn't match."""
    return F.when(word.rlike(before), F.regexp_replace(word, f"{before}(.*)$", "$1")).otherwise(F.lit(""))


def _strip(word: Column, n: Column) -> Column:
    return F.substring(word, F.lit(1), F.greatest(F.length(word) - n, F.lit(0)))


def _cut(word: Column, pattern: str, room: Column) -> Column:
    """``word`` without the suffix that ``pattern`` finds, if that is no longer than ``room``."""
    found = F.length(F.regexp_extract(word, pattern, 0))
    return F.when((found > 0) & (found <= room), _strip(word, found)).otherwise(word)


def _nouns(w: Column, r1: Column, r2: Column, rv: Column) -> Column:
    """The first step, on a word and the lengths of its regions."""

    def act(s: Column) -> Column:
        n, out = F.length(s), w
        in_r2 = n <= r2

        def chain(first: Column, pattern: str) -> Column:
            return _let(first, lambda rest: _cut(rest, longest(pattern.split("|")), r2 - n))

        amente = _let(_strip(w, n), lambda rest: F.when(rest.endswith("iv") & (r2 - n >= 2), _let(_strip(rest, F.lit(2)), lambda x: _cut(x, "at$", r2 - n - 2)))
                      .otherwise(_cut(rest, longest(("os", "ic", "ad")), r2 - n)))
        out = F.when((s == "amente") & (n <= r1), amente)
        for pattern in sorted(set(BEFORE.values())):
            out = out.when(s.isin(*[k for k, v in BEFORE.items() if v == pattern]) & in_r2, chain(_strip(w, n), pattern))
        for suffix, new in REPLACED.items():
            out = out.when((s == suffix) & in_r2, F.concat(_strip(w, n), F.lit(new)))
        out = out.when(s.isin("ira", "iras") & (n <= rv) & _strip(w, n).endswith("e"), F.concat(_strip(w, n), F.lit("ir")))
        return out.when(s.isin(*NOUNS) & in_r2, _strip(w, n)).otherwise(w)

    every = longest((*NOUNS, *REPLACED, *BEFORE, "amente", "iras", "ira"))
    return _let(F.regexp_extract(w, every, 0), act)


def _stem(w: Column) -> Column:
    def with_regions(r1: Column, rv: Column) -> Column:
        r2 = F.length(_region(r1, BEFORE_R1))
        # Regions end where the word ends, so what a cut takes from the word it takes from them.
        room = lambda x: F.length(rv) - (F.length(w) - F.length(x))
        noun = _nouns(w, F.length(r1), r2, F.length(rv))
        verb = lambda x: F.when(x != w, x).otherwise(_strip(w, F.length(F.regexp_extract(rv, longest(VERBS), 0))))
        ending = lambda x: F.when(x != w, F.when(x.endswith("ci") & (room(x) >= 1), _strip(x, F.lit(1))).otherwise(x)).otherwise(
            _cut(x, longest(RESIDUAL), room(x)))
        last = lambda x: F.when(x.rlike("[eéê]$") & (room(x) >= 1), _let(_strip(x, F.lit(1)), lambda y: F.when(
            y.rlike("(?:gu|ci)$") & (room(y) >= 1), _strip(y, F.lit(1))).otherwise(y))).otherwise(F.regexp_replace(x, "ç$", "c"))
        return _let(noun, lambda a: _let(verb(a), lambda b: _let(ending(b), last)))

    return _let(_region(w, BEFORE_R1), lambda r1: _let(_region(w, BEFORE_RV), lambda rv: with_regions(r1, rv)))


def stem(word: Column | str) -> Column:
    """The stem of a lower-case word; a null stays null."""
    marked = F.replace(F.replace(col(word), F.lit("ã"), F.lit("a~")), F.lit("õ"), F.lit("o~"))
    return F.replace(F.replace(_let(marked, _stem), F.lit("a~"), F.lit("ã")), F.lit("o~"), F.lit("õ"))


def stemmed_terms(text: Column | str) -> Column:
    """The stems of a text's words that aren't stop words, in order."""
    return F.transform(F.filter(tokens(text), lambda t: ~t.isin(*STOP_WORDS)), stem)


def stems_sql(words: str) -> str:
    """DuckDB SQL of (w, stem) for the words ``w`` of a table: one column for each step."""

    def cut(text: str, pattern: str, room: str) -> str:
        n = f"length(regexp_extract({text}, '{pattern}'))"
        return f"CASE WHEN {n} BETWEEN 1 AND {room} THEN left({text}, length({text}) - {n}) ELSE {text} END"

    listed = lambda names: ", ".join(f"'{n}'" for n in names)
    before = "\n".join(
        f"WHEN s IN ({listed(k for k, v in BEFORE.items() if v == p)}) AND n <= r2 THEN {cut('t', longest(p.split('|')), 'r2 - n')}" for p in sorted(set(BEFORE.values()))
    )
    replaced = "\n".join(f"WHEN s = '{k}' AND n <= r2 THEN t || '{v}'" for k, v in REPLACED.items())
    every = longest((*NOUNS, *REPLACED, *BEFORE, "amente", "iras", "ira"))
    room = lambda text: f"(length(rv) - length(x) + length({text}))"
    return f"""(WITH m AS (SELECT w, replace(replace(w, 'ã', 'a~'), 'õ', 'o~') AS x FROM {words}),
r AS (SELECT *, regexp_extract(x, '{BEFORE_R1}(.*)$', 1) AS one, regexp_extract(x, '{BEFORE_RV}(.*)$', 1) AS rv FROM m),
s AS (SELECT *, length(one) AS r1, length(regexp_extract(one, '{BEFORE_R1}(.*)$', 1)) AS r2, regexp_extract(x, '{every}') AS s FROM r),
t AS (SELECT *, length(s) AS n, left(x, length(x) - length(s)) AS t FROM s),
a AS (SELECT *, CASE WHEN s = 'amente' AND n <= r1 THEN CASE WHEN t LIKE '%iv' AND r2 - n >= 2 THEN {cut("left(t, length(t) - 2)", "at$", "r2 - n - 2")}
    ELSE {cut("t", longest(("os", "ic", "ad")), "r2 - n")} END
  {before}
  {replaced}
  WHEN s IN ('ira', 'iras') AND n <= length(rv) AND t LIKE '%e' THEN t || 'ir' WHEN s IN ({listed(NOUNS)}) AND n <= r2 THEN t ELSE x END AS a FROM t),
b AS (SELECT *, CASE WHEN a <> x THEN a ELSE left(x, length(x) - length(regexp_extract(rv, '{longest(VERBS)}'))) END AS b FROM a),
c AS (SELECT *, CASE WHEN b = x THEN {cut("b", longest(RESIDUAL), room("b"))} WHEN b LIKE '%ci' AND {room("b")} >= 1 THEN left(b, length(b) - 1) ELSE b END AS c FROM b),
d AS (SELECT *, left(c, length(c) - 1) AS short FROM c),
e AS (SELECT w, CASE WHEN regexp_matches(c, '[eéê]$') AND {room("c")} >= 1 THEN CASE WHEN regexp_matches(short, '(gu|ci)$') AND {room("short")} >= 1
  THEN left(short, length(short) - 1) ELSE short END ELSE regexp_replace(c, 'ç$', 'c') END AS e FROM d)
SELECT w, replace(replace(e, 'a~', 'ã'), 'o~', 'õ') AS stem FROM e)"""
