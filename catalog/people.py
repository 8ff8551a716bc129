"""Profiles: gap, roadmap, prompt, the whole analysis and the report (I4-I8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import SCORES_SQL, skill_lists
from catalog.common import (
    JOB_SKILLS_SQL, JOB_VECTORS_SQL, JOBS_SQL, PROFILE_VECTORS_SQL, PROFILES_SQL, SQL_WS, case,
    job_skill_rows, job_vectors, jobs, profile_vectors, profiles, sql_strip,
)
from catalog.vectors import (
    QUESTION_SHORTLIST_SQL, SHORTLIST_SQL, _with_centre, letter_encoder, question_vectors, questions,
)
from jobloom.functions.text import line_count, word_count
from jobloom.functions.vectors import cosine_similarity
from jobloom.operators.encode import encode_texts
from jobloom.plans import career
from jobloom.plans.report import (
    ALL_SECTIONS, ANY_SECTION, evaluation_report, similarity_scores, write_report,
)
from jobloom.plans.roadmap import (
    PROMPT_QUESTIONS, PROMPT_ROLES, PROMPT_SKILLS, ROADMAP_GAPS, ROADMAP_QUESTIONS,
    ROADMAP_ROLES, ROADMAP_SKILLS, PromptWording, RoadmapWording,
)
from jobloom.session import checkpoint, scratch_path

# One row per profile with its four lists, in SQL.
ROWS_SQL = f"""with hits as materialized ({SHORTLIST_SQL}),
  asked as materialized ({QUESTION_SHORTLIST_SQL}),
  titles as (select profile_id, list(title order by rank, title) as similar_roles from (
      select profile_id, title, min(rank) as rank from hits
      join ({JOBS_SQL}) using (job_id) group by 1, 2) group by 1),
  demand as (select profile_id, skill, count(*) as n from hits
      join (select job_id, skill from ({JOB_SKILLS_SQL})) using (job_id) group by 1, 2),
  skills as (select profile_id, list(skill order by n desc, skill) as target_skills from (
      select *, row_number() over (partition by profile_id order by n desc, skill) as r
      from demand) where r <= 30 group by 1),
  talk as (select profile_id, list(text order by rank) as questions from asked
      join benchmark on item_id = q_id group by 1),
  lists as (select profile_id, target_role,
      list_filter(list_transform(string_split(skills, ','), lambda s: {sql_strip('s')}),
        lambda s: s <> '') as user_skills,
      coalesce(similar_roles, []) as similar_roles,
      coalesce(target_skills, []) as target_skills, coalesce(questions, []) as questions
    from ({PROFILES_SQL}) left join titles using (profile_id)
      left join skills using (profile_id) left join talk using (profile_id)),
  rows as (select *, list_filter(target_skills, lambda s: {sql_strip('s')} <> '' and not
      list_contains(list_transform(user_skills, lambda u: lower({sql_strip('u')})),
        lower({sql_strip('s')}))) as skill_gap from lists)"""


def _hits(t):
    vectors = profile_vectors(t)
    return (checkpoint(career.shortlist_jobs(vectors, job_vectors(t), jobs(t))),
            career.shortlist_questions(vectors, question_vectors(t), questions(t)))


def profile_rows(t):
    job_hits, question_hits = _hits(t)
    return career.with_gap(career.career_inputs(
        profiles(t), job_hits, jobs(t), job_skill_rows(t).select("job_id", "skill"),
        question_hits, questions(t)))


@case(f"""{ROWS_SQL} select profile_id, array_to_string(user_skills, '|') as user_skills,
        array_to_string(target_skills, '|') as target_skills,
        array_to_string(skill_gap, '|') as skill_gap from rows""")
def i5(t):
    return profile_rows(t).select("profile_id", *[
        F.array_join(c, "|").alias(c) for c in ("user_skills", "target_skills", "skill_gap")])


def _lit(s: str) -> str:
    """A SQL literal; line ends as code points, so that no engine reads an escape."""
    return "(" + " || chr(10) || ".join(
        "'" + p.replace("'", "''") + "'" for p in s.split("\n")) + ")"


def _bullets(items: str) -> str:
    return f"array_to_string(list_transform({items}, lambda s: '- ' || s), chr(10))"


def _numbered(items: str) -> str:
    return (f"array_to_string(list_transform({items}, lambda s, i: "
            "cast(i as string) || '. ' || s), chr(10))")


def _part(items: str, head: str, most: int, otherwise: str, show=_bullets) -> str:
    return (f"case when len({items}) > 0 then {_lit(head)} || chr(10) || "
            f"{show(f'{items}[1:{most}]')} else {_lit(otherwise)} end")


def roadmap_sql(gap: str) -> str:
    w = RoadmapWording()
    name = f"coalesce(nullif(target_role, ''), {_lit(w.role_default)})"
    top, asked = f"target_skills[1:{career.SKILLS_SHOWN}]", f"questions[1:{career.QUESTIONS_SHOWN}]"
    parts = [
        f"{_lit(w.title)} || {name}", _lit(w.profile),
        f"case when len(user_skills) > 0 then {_bullets('user_skills')} "
        f"else {_lit(w.none_listed)} end",
        _part("similar_roles", w.roles, ROADMAP_ROLES, w.no_roles), _lit(w.gap),
        _part(f"({top})", w.skills, ROADMAP_SKILLS, w.no_skills),
        _part(f"({gap})", w.gaps, ROADMAP_GAPS, w.no_gaps), _lit(w.plan), _lit(w.questions_head),
        _part(f"({asked})", w.questions, ROADMAP_QUESTIONS, w.no_questions, _numbered),
        _lit(w.routine), f"{_lit(w.closing)} || '**' || {name} || '**.'",
    ]
    return " || chr(10) || ".join(parts)


# The roadmap sees the ten most demanded skills only.
_TOP_GAP = (f"list_filter(target_skills[1:{career.SKILLS_SHOWN}], lambda s: not list_contains("
            "list_transform(user_skills, lambda u: lower(u)), lower(s)))")


@case(f"{ROWS_SQL} select profile_id, {roadmap_sql(_TOP_GAP)} as roadmap from rows")
def i6(t):
    return career.with_roadmap(profile_rows(t)).select("profile_id", "roadmap")


def prompt_sql() -> str:
    w = PromptWording()

    def joined(items, most):
        return (f"case when len({items}) > 0 then array_to_string({items}[1:{most}], ', ') "
                f"else {_lit(w.none)} end")

    return " || ".join([
        _lit(w.intro), "coalesce(target_role, '')", _lit(w.user),
        "case when len(user_skills) > 0 then array_to_string(list_sort(list_distinct("
        f"user_skills)), ', ') else {_lit(w.no_user)} end",
        _lit(w.target), joined("target_skills", PROMPT_SKILLS),
        _lit(w.roles), joined("similar_roles", PROMPT_ROLES), _lit(w.questions),
        f"case when len(questions) > 0 then {_bullets(f'questions[1:{PROMPT_QUESTIONS}]')} "
        f"else {_lit(w.none)} end", _lit(w.task)])


@case(f"{ROWS_SQL} select profile_id, {prompt_sql()} as prompt from rows")
def i7(t):
    return career.with_prompt(profile_rows(t)).select("profile_id", "prompt")


I4_SQL = f"""{ROWS_SQL}, texts as (select *, {roadmap_sql(_TOP_GAP)} as roadmap from rows)
      select profile_id, array_to_string(similar_roles, '|') as similar_roles,
        array_to_string(skill_gap, '|') as skill_gap,
        cast(len(questions) as bigint) as questions,
        cast(len(list_filter(regexp_split_to_array(roadmap, '{SQL_WS}+'), lambda w: w <> ''))
          as bigint) as words,
        cast(len(string_split(roadmap, chr(10))) as bigint) as lines
      from texts"""


def _analysed(analysis):
    return analysis.select(
        "profile_id", F.array_join("similar_roles", "|").alias("similar_roles"),
        F.array_join("skill_gap", "|").alias("skill_gap"),
        F.size("questions").cast("bigint").alias("questions"),
        word_count("roadmap").cast("bigint").alias("words"),
        line_count("roadmap").cast("bigint").alias("lines"))


@case(I4_SQL)
def i4(t):
    return _analysed(career.analyze_careers(
        profiles(t), jobs(t), job_vectors(t), job_skill_rows(t).select("job_id", "skill"),
        questions(t), question_vectors(t), queries=(profile_vectors(t), profile_vectors(t))))


def _letters_sql(rows: str, key: str, text: str) -> str:
    """key, embedding: the vectors that letter_encoder makes of a text column."""
    counts = ", ".join(f"len(lower({text})) - len(replace(lower({text}), '{chr(97 + i)}', ''))"
                       for i in range(26))
    return (f"select {key}, list_transform(v, lambda y: (y / coalesce(nullif(sqrt(list_sum("
            f"list_transform(v, lambda x: x * x))), 0), 1))::float) as embedding "
            f"from (select {key}, [{counts}]::double[] as v from ({rows}) where {text} is not null)")


_ASKED_SQL = f"""select profile_id,
    'Target role: ' || coalesce(target_role, '') || '. Current skills: ' || skills as for_jobs,
    'Technical interview questions for ' || coalesce(target_role, '') || '. Candidate skills: '
      || skills as for_questions from ({PROFILES_SQL})"""


def _from_text(sql: str) -> str:
    """The analysis in SQL with vectors made of the texts."""
    vectors = f"""with jv as materialized ({_letters_sql(JOBS_SQL, 'job_id', 'description')}),
      qv as materialized ({_letters_sql('select item_id, text from benchmark', 'item_id', 'text')}),
      pj as materialized ({_letters_sql(_ASKED_SQL, 'profile_id', 'for_jobs')}),
      pq as materialized ({_letters_sql(_ASKED_SQL, 'profile_id', 'for_questions')}),"""
    jobs_part = SHORTLIST_SQL.replace(f"({PROFILE_VECTORS_SQL})", "pj").replace(
        f"({JOB_VECTORS_SQL})", "jv")
    asked_part = QUESTION_SHORTLIST_SQL.replace(f"({PROFILE_VECTORS_SQL})", "pq").replace(
        "embeddings v", "(select item_id as vec_id, embedding from qv) v")
    return sql.replace(SHORTLIST_SQL, jobs_part).replace(QUESTION_SHORTLIST_SQL, asked_part).replace(
        "with hits", vectors + " hits", 1)


@case(_from_text(I4_SQL))
def i4_text(t):
    """The analysis from texts alone: postings, questions and profiles are encoded first."""
    job_texts = jobs(t).select("job_id", "description")
    asked = questions(t).select("q_id", "question")
    analysis = career.analyze_careers(
        profiles(t), jobs(t),
        checkpoint(encode_texts(job_texts, "description", letter_encoder).drop("description")),
        job_skill_rows(t).select("job_id", "skill"), questions(t),
        checkpoint(encode_texts(asked, "question", letter_encoder).drop("question")),
        make_encoder=letter_encoder)
    return _analysed(analysis)


def _all(phrases, glue):
    return f" {glue} ".join(f"contains(lower(text), '{p}')" for p in phrases)


def _scored(t):
    return _with_centre(t).select(
        "vec_id", F.size("embedding").alias("dim"),
        F.round(cosine_similarity("embedding", "c"), 9).alias("score"))


@case("""select e.vec_id as id, round(list_cosine_similarity(
        e.embedding::double[], c.embedding::double[]), 6) as score
      from embeddings e join (select vec_id as label, embedding from embeddings) c using (label)""")
def i8_scores(t):
    """All scores, written and read again."""
    path = scratch_path(t.spark, "report")
    scored = _scored(t)
    write_report(evaluation_report(skill_lists(t), scored, t.documents, "text"), path,
                 similarity_scores(scored, "vec_id"))
    back = t.spark.read.schema("id long, score double").json(f"{path}_scores")
    return back.select("id", F.round("score", 6).alias("score"))


@case(f"""with s as ({SCORES_SQL}),
      v as (select vec_id, list_cosine_similarity(e.embedding::double[], c.embedding::double[]) as c
            from embeddings e join (select vec_id as label, embedding from embeddings) c
            using (label))
      select total_tp, total_fp, total_fn, f1_score,
        (select cast(count(*) as bigint) from v) as n_scores, cast(64 as bigint) as dim,
        (select round(avg(c), 6) from v) as mean_similarity,
        (select round(min(c), 6) from v) as min_similarity,
        (select cast(sum(len(list_filter(regexp_split_to_array(text, '{SQL_WS}+'),
          lambda w: w <> ''))) as bigint) from documents) as words,
        (select cast(count(*) as bigint) from documents where {_all(ANY_SECTION, 'or')}) as any_of,
        (select cast(count(*) as bigint) from documents where {_all(ALL_SECTIONS, 'and')}) as all_of
      from s""")
def i8(t):
    report = evaluation_report(skill_lists(t), _scored(t), t.documents, "text")
    s, e, r = "skill_extraction", "embeddings", "roadmap"
    return report.select(
        *[F.col(f"{s}.{c}") for c in ("total_tp", "total_fp", "total_fn")],
        F.round(f"{s}.f1_score", 9).alias("f1_score"), F.col(f"{e}.n_scores"),
        F.col(f"{e}.embedding_dimension").cast("bigint").alias("dim"),
        F.round(f"{e}.mean_similarity", 6).alias("mean_similarity"),
        F.round(f"{e}.min_similarity", 6).alias("min_similarity"),
        F.col(f"{r}.output_word_count").alias("words"),
        F.col(f"{r}.with_any_section").alias("any_of"),
        F.col(f"{r}.with_all_sections").alias("all_of"))


CASES = {
    "i4_career_analysis": i4,
    "i4_career_analysis_from_text": i4_text,
    "i5_skill_gap": i5,
    "i6_roadmap_texts": i6,
    "i7_prompt_texts": i7,
    "i8_evaluation_report": i8,
    "i8_similarity_scores": i8_scores,
}
