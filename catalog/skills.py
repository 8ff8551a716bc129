"""Skill extraction (G1-G6, I2) over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import case
from jobloom.functions.skills import extract_skills
from jobloom.functions.vocabulary import default_vocabulary, phrase_rows
from jobloom.operators.phrases import match_phrases
from jobloom.plans.enrichment import question_skills, skill_pairs

# No vocabulary phrase occurs in the test texts, so every document gets two: all phrases
# in turn, then spellings that should and should not match.
_SPELLINGS = ["Node JS", "GOLANG", "C++x", "c++", "C#", "c#9", "machine  learning", "éjava",
              "SQL Server,", "TCP/IP.", "google cloud platform", "sql-server", "java_", "React.JS!"]
PHRASES = sorted(p for alts in default_vocabulary().values() for p in alts)
INJECTED = PHRASES + _SPELLINGS
_W = r"[\p{L}\p{N}_]"


def _quoted(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


_PICK = "[{list}][cast(doc_id * {step} % {n} as int) + 1]"
SKILL_DOCS_SQL = (
    "select doc_id, concat_ws(' ', text, "
    + _PICK.format(list=_quoted(INJECTED), step=1, n=len(INJECTED)) + ", 'end', "
    + _PICK.format(list=_quoted(_SPELLINGS), step=5, n=len(_SPELLINGS)) + ") as body "
    "from documents")


def skill_docs(t):
    def pick(items, step):
        at = (F.col("doc_id") * step % len(items) + 1).cast("int")
        return F.element_at(F.split(F.lit("\u0001".join(items)), "\u0001"), at)

    return t.documents.select("doc_id", "lang", F.concat_ws(
        " ", "text", pick(INJECTED, 1), F.lit("end"), pick(_SPELLINGS, 5)).alias("body"))


def _edges(phrase: str, symbol_safe: bool) -> tuple[str, str]:
    def edge(ch, anchor):
        if ch.isalnum() or ch == "_" or symbol_safe:
            return f"({anchor}|[^\\p{{L}}\\p{{N}}_])"
        return _W

    return edge(phrase[0], "^"), edge(phrase[-1], "$")


def _escaped(phrase: str) -> str:
    return "".join(c if c.isalnum() or c == " " else f"\\{c}" for c in phrase)


def pairs_sql(docs: str, rows, symbol_safe: bool = False) -> str:
    """(doc_id, skill) by one pattern per phrase, tried on every document."""
    tests = ", ".join(
        "case when regexp_matches(body, {}) then {} end".format(
            _quoted(["(?i)" + _edges(p, symbol_safe)[0] + _escaped(p)
                     + _edges(p, symbol_safe)[1]]), _quoted([s]))
        for p, s in rows)
    return (f"select distinct doc_id, skill from (select doc_id, unnest([{tests}]) as skill "
            f"from ({docs}) d) where skill is not null")


def lists_sql(docs: str, rows, symbol_safe: bool = False) -> str:
    return (f"with d as materialized ({docs}), p as ({pairs_sql('select * from d', rows, symbol_safe)}) "
            "select d.doc_id, coalesce(string_agg(skill, '|' order by skill), '') as skills "
            "from d left join p on p.doc_id = d.doc_id group by d.doc_id")


_ROWS = phrase_rows(default_vocabulary())

# A vocabulary passed in by the caller, of words that do occur in the texts.
WORDS = {"english": ["the", "of the", "and", "with by"], "german": ["und", "in nicht"],
         "french": ["la", "le", "de la"], "spanish": ["el", "los", "de los"], "the": ["the"]}


@case(lists_sql("select doc_id, text as body from documents",
                phrase_rows(WORDS, stopwords=("french",))))
def g1(t):
    found = extract_skills("text", WORDS, stopwords=("french",))
    return t.documents.select("doc_id", F.array_join(found, "|").alias("skills"))


@case(lists_sql(SKILL_DOCS_SQL, _ROWS))
def g2(t):
    return skill_docs(t).select(
        "doc_id", F.array_join(extract_skills("body"), "|").alias("skills"))


@case(lists_sql(SKILL_DOCS_SQL, _ROWS, symbol_safe=True))
def g2_symbols(t):
    return skill_docs(t).select(
        "doc_id", F.array_join(extract_skills("body", symbol_safe=True), "|").alias("skills"))


@case("""with w as (select distinct unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as w
                  from benchmark),
      d as (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as w
            from documents)
      select doc_id, cast(count(distinct w) as bigint) as words from d semi join w using (w)
      group by 1""")
def g2_table(t):
    """A vocabulary table that grows with the data: every word of the benchmark texts."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    vocabulary = t.benchmark.select(F.explode(words).alias("phrase")).distinct().withColumn(
        "skill", F.col("phrase"))
    return match_phrases(t.documents, "doc_id", "text", vocabulary).groupBy("doc_id").agg(
        F.count("*").alias("words"))


@case(lists_sql(SKILL_DOCS_SQL, _ROWS, symbol_safe=True))
def g2_table_symbols(t):
    """The built-in vocabulary as a table."""
    docs = skill_docs(t)
    vocabulary = t.spark.createDataFrame(_ROWS, "phrase string, skill string")
    found = match_phrases(docs, "doc_id", "body", vocabulary, symbol_safe=True).groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_list("skill")), "|").alias("skills"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("skills", F.lit("")).alias("skills"))


_BLANKS = ("select doc_id, case when lang = 'es' then null when lang = 'de' then '' "
           "else body end as body from ({docs}) join documents using (doc_id)")


@case(lists_sql(_BLANKS.format(docs=SKILL_DOCS_SQL), _ROWS))
def g3(t):
    body = (F.when(F.col("lang") == "es", None).when(F.col("lang") == "de", "")
            .otherwise(F.col("body")))
    return skill_docs(t).select("doc_id", F.array_join(extract_skills(body), "|").alias("skills"))


@case(pairs_sql(SKILL_DOCS_SQL, _ROWS))
def g5(t):
    return skill_pairs(skill_docs(t), "doc_id", "body")


_TALK = ("select conv_id * 1000 + turn as doc_id, concat_ws(' ', text, role, 'sql and', "
         "case when role = 'user' then 'Power BI' else 'k8s!' end) as body from conversations")


@case(f"select doc_id as q_id, skill from ({pairs_sql(_TALK, _ROWS)})")
def g6(t):
    tail = F.when(F.col("role") == "user", "Power BI").otherwise("k8s!")
    q = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("q_id"),
                               F.concat_ws(" ", "text", "role", F.lit("sql and"), tail)
                               .alias("question"))
    return question_skills(q)


def _stopped(pairs: str) -> str:
    return f"select skill, cast(count(*) as bigint) as jobs from ({pairs}) group by 1"


@case(_stopped(pairs_sql(SKILL_DOCS_SQL, _ROWS)))
def g4(t):
    found = skill_docs(t).select(F.explode(extract_skills("body")).alias("skill"))
    return found.groupBy("skill").agg(F.count("*").alias("jobs"))


CASES = {
    "g1_caller_vocabulary": g1,
    "g2_phrase_match": g2,
    "g2_phrase_match_symbol_safe": g2_symbols,
    "g2_phrase_table_symbol_safe": g2_table_symbols,
    "g2_phrase_match_table": g2_table,
    "g3_empty_texts": g3,
    "g4_whole_table_demand": g4,
    "g5_skill_pairs": g5,
    "g6_question_skills": g6,
}
