"""Licence scans by sentence rules, with DataFrame functions only.

A text is normalised: A-Z are lower-cased, every run of other characters is one space,
comment leaders included; a line feed and a colon stay as a mark, since a sentence may begin
or end there; a full stop, question or exclamation mark before white space, and a line
without letters or digits, cut.  Names, years and holders are replaced by a word that stands
for them, spellings of "licence" and "version" and the ways to say that something is under a
licence by one form.  A known sentence is found where it fills everything from one mark or cut to
another, also when it is wrapped over lines of a comment; parts of it are not found.
At one place the longest sentence counts.

Normalised sentences are mapped to identifiers, and a document's identifiers, in order of
position, are matched against the ordered licence rules: a rule holds when its identifiers
occur in its order.  Rules are ordered from specific to general; a document's licence is that
of the first rule that holds, and all rules that hold are listed in rule order.

A text without any anchor word cannot hold a known sentence and is not normalised; that
filter is exact.  Rows are scanned where they are, nothing is shuffled, so rows that repeat
an id or a text are scanned each; texts are scanned whole at any length.  Null and empty texts have no
licence.  Columns named sentences, rules and licence are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .licence_table import LEADS, RULES, SENTENCES, VARIABLES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every known sentence holds one of these, inside words, so that spacing and punctuation don't matter.
ANCHORS = ("licen", "permission", "warrant", "software", "redistribut", "copyright", "reserved", "mozilla", "mpl")
# An abbreviation before a small letter or a digit does not end a sentence.
_ABBREVIATED = (r"(^|[^A-Za-z0-9])([Ii]nc|INC|[Ll]td|LTD|[Cc]o|[Cc]orp|[Vv]er|[Vv])\.([ \t\r\n#/*;<>!-]+[a-z0-9])", r"\1\2 \3")
# A plus after a version is "or later".
_PLUS = (r"([Gg][Pp][Ll][ -]?[Vv]?[0-9](?:[.][0-9])?)[+]", r"\1 or later")
# Steps of normalising, in order: (pattern, replacement), the same in both engines.
_STEPS = (
    (r"\r\n?", "\n"),
    (r"(\n[ \t]*)(?:rem|dnl)[ \t]", r"\1"),
    (r"""[.!?]["')\]]*[ \t\n]+""", "|"),
    (r"[^a-z0-9|\n:]+", " "),
    (r"\n[ \n]*\n", "|"),
    (r" ?[:\n][ :\n]*", "\n\n"),
    (r"[ \n]*[|][ |\n]*", "||"),
)


def _plain(said: str) -> str:
    return re.sub("[^a-z0-9]+", " ", said.lower()).strip()


def known() -> dict[str, str]:
    """Identifier of each normalised sentence, longest first."""
    found = {}
    for key, said in SENTENCES:
        plain = _plain(re.sub(*_PLUS, said))
        for pattern, to in VARIABLES:
            plain = re.sub(pattern, to, f"||{plain}||").strip("|")
        for pattern, to in LEADS:
            plain = re.sub(f"^{pattern}", to, plain)
        if not any(a in plain for a in ANCHORS):
            raise ValueError(f"no anchor in: {said}")
        if found.setdefault(plain, key) != key:
            raise ValueError(f"two identifiers: {said}")
    return dict(sorted(found.items(), key=lambda f: (-len(f[0]), f)))


def _pattern() -> str:
    forms = {"": "", **{to: pattern for pattern, to in LEADS}}
    said = []
    for to, lead in forms.items():
        rest = [p[len(to) :] for p in known() if next((t for _, t in LEADS if p.startswith(t)), "") == to]
        said.append(lead + "(?:" + "|".join(p.replace(" ", r"[ \n]+") for p in rest) + ")")
    said = "|".join(said)
    # Marks and cuts are doubled, so that sentences that follow one another each have their own.
    return rf"[|\n] ?({said}) ?[|\n]"


def normalised(text: Column) -> Column:
    """The text with one space between words, "|" doubled at cuts and line feeds doubled at marks."""

    def replaced(out: Column, steps: tuple) -> Column:
        for pattern, to in steps:
            out = F.regexp_replace(out, pattern, re.sub(r"\\(\d)", r"$\1", to))
        return out

    out = replaced(F.translate(replaced(text, (_ABBREVIATED, _PLUS)), _UPPER + "|", _LOWER + " "), _STEPS)
    return replaced(F.concat(F.lit("||"), out, F.lit("||")), VARIABLES)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences in a text, by position."""
    found = F.regexp_extract_all(normalised(text), F.lit(_pattern()), F.lit(1))
    ids = F.create_map(*[F.lit(x) for pair in known().items() for x in pair])

    def identifier(m: Column) -> Column:
        plain = F.regexp_replace(m, r"[ \n]+", " ")
        for pattern, to in LEADS:
            plain = F.regexp_replace(plain, f"^{pattern}", to)
        return F.element_at(ids, plain)

    said = F.transform(found, identifier)
    return F.when(text.rlike("(?i)" + "|".join(ANCHORS)), said).otherwise(F.array().cast("array<string>"))


def _like(ids: tuple[str, ...]) -> str:
    return "%" + "%".join(f",{i}," for i in ids) + "%"


def scan(docs: DataFrame) -> DataFrame:
    """Add sentences, rules and licence to every row."""
    seq = docs.withColumn("sentences", F.coalesce(sentence_ids(F.col("text")), F.array().cast("array<string>")))
    line = F.concat(F.lit(","), F.array_join("sentences", ",,"), F.lit(","))
    held = F.array(*[F.when(line.like(_like(ids)), F.struct(F.lit(r).alias("rule"), F.lit(x).alias("licence"))) for r, x, ids in RULES])
    held = F.when(F.size("sentences") > 0, F.array_compact(held)).otherwise(F.array().cast("array<struct<rule: string, licence: string>>"))
    seq = seq.withColumn("rules", held)
    return seq.withColumn("licence", F.get("rules", F.lit(0))["licence"]).withColumn("rules", F.transform("rules", lambda r: r["rule"]))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sentences, rules and licence of every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("sentences", ",").alias("sentence_ids"),
        F.array_join("rules", ",").alias("rules"), F.coalesce("licence", F.lit("none")).alias("licence"),
    )


def oracle() -> str:
    """The same rules in SQL, on every text, without the filter by anchors."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    replaced = lambda s, steps: s if not steps else replaced(f"regexp_replace({s}, {quote(steps[0][0])}, {quote(steps[0][1])}, 'g')", steps[1:])
    plain = f"translate({replaced('text', (_ABBREVIATED, _PLUS))}, {quote(_UPPER + '|')}, {quote(_LOWER + ' ')})"
    norm = replaced(f"'||' || {replaced(plain, _STEPS)} || '||'", VARIABLES)
    ids = ", ".join(f"({quote(s)}, {quote(k)})" for s, k in known().items())
    said = replaced("regexp_replace(unnest(found), '[ \\n]+', ' ', 'g')", tuple((f"^{pattern}", to) for pattern, to in LEADS))
    rules = ", ".join(f"({i}, {quote(r)}, {quote(x)}, {quote(_like(want))})" for i, (r, x, want) in enumerate(RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({norm}, {quote(_pattern())}, 1) AS found FROM documents),
s AS (SELECT row, generate_subscripts(found, 1) AS pos, {said} AS said FROM d),
seq AS (SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY pos) AS ids, ',' || string_agg(id, ',,' ORDER BY pos) || ',' AS line FROM s JOIN (VALUES {ids}) k(said, id) USING (said) GROUP BY row),
ok AS (SELECT row, string_agg(rule, ',' ORDER BY k) AS rules, arg_min(licence, k) AS licence FROM seq JOIN (VALUES {rules}) r(k, rule, licence, pat) ON line LIKE pat GROUP BY row)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(rules, '') AS rules, coalesce(licence, 'none') AS licence
FROM d LEFT JOIN seq USING (row) LEFT JOIN ok USING (row)
"""
