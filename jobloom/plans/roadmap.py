"""Roadmap and prompt texts, one per profile row, built from array columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from jobloom.functions.lists import bind, skill_gap, stripped
from jobloom.functions.text import _col

# How many entries of each list a roadmap and a prompt show.
ROADMAP_ROLES, ROADMAP_SKILLS, ROADMAP_GAPS, ROADMAP_QUESTIONS = 6, 20, 8, 10
PROMPT_SKILLS, PROMPT_ROLES, PROMPT_QUESTIONS = 25, 5, 8


@dataclass(frozen=True)
class RoadmapWording:
    """Every fixed sentence of a roadmap; pass another instance to change the wording."""

    role_default: str = "your target role"
    title: str = "# Career roadmap for "
    profile: str = "\n## 1. Where you stand\n\n**Skills you listed:**"
    none_listed: str = "_Nothing listed so far._"
    roles: str = "\n**Job titles close to this role:**"
    no_roles: str = "\nThe data holds no close job titles, so the steps below rest on skills alone."
    gap: str = "\n## 2. Skill gap\n"
    skills: str = "**What postings ask for most:**"
    no_skills: str = "The postings gave no clear skills, so deepen the ones you already have."
    gaps: str = "\n**Learn these first:**"
    no_gaps: str = "\nYou already cover what postings ask for: work on depth and on projects."
    plan: str = (
        "\n## 3. Plan for twelve weeks\n\n"
        "### Weeks 1-3: close the first gaps\n"
        "- Choose two or three skills from the list above.\n"
        "- For each: one course, one small project, one page of notes.\n\n"
        "### Weeks 4-6: one larger project\n"
        "- Build something a team in this role would use, from data to result.\n"
        "- Publish it with tests and a short description.\n\n"
        "### Weeks 7-9: design and interview practice\n"
        "- Answer three interview questions a week in writing and with code.\n"
        "- Practise telling the story of your project.\n\n"
        "### Weeks 10-12: applications and networking\n"
        "- Bring your CV up to date with measured results.\n"
        "- Apply every week and talk to people who hold the role."
    )
    questions_head: str = "\n## 4. Interview questions\n"
    questions: str = "Work through these; write an answer and an example for each:"
    no_questions: str = "No questions were found in the data; collect some for this role yourself."
    routine: str = (
        "\n## 5. A week at a glance\n\n"
        "- Three long blocks of study or project work.\n"
        "- Two shorter blocks of coding practice.\n"
        "- One hour for your public work and one for contacts."
    )
    closing: str = (
        "\n## 6. Keeping the roadmap alive\n\n"
        "Look back at the end of each week and change the plan where it did not fit.\n\n"
        "Kept up, this prepares you for the role of "
    )


def bullets(items: Column, prefix: str = "- ") -> Column:
    return F.array_join(F.transform(items, lambda s: F.concat(F.lit(prefix), s)), "\n")


def numbered(items: Column) -> Column:
    return F.array_join(
        F.transform(items, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s)), "\n")


def _items(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.array().cast("array<string>"))


def roadmap_text(role, user_skills, target_skills, similar_roles, sample_questions,
                 wording: RoadmapWording = RoadmapWording()) -> Column:
    w = wording
    named = _col(role)
    name = F.when(named.isNull() | (named == ""), F.lit(w.role_default)).otherwise(named)

    def part(items: Column, head: str, most: int, otherwise: str, show=bullets) -> Column:
        listed = F.concat(F.lit(head + "\n"), show(F.slice(items, 1, most)))
        return F.when(F.size(items) > 0, listed).otherwise(F.lit(otherwise))

    def body(z: Column) -> Column:
        user, target = z["lists"]["user"], z["lists"]["target"]
        return F.concat_ws(
            "\n",
            F.concat(F.lit(w.title), z["name"]),
            F.lit(w.profile),
            F.when(F.size(user) > 0, bullets(user)).otherwise(F.lit(w.none_listed)),
            part(z["roles"], w.roles, ROADMAP_ROLES, w.no_roles),
            F.lit(w.gap),
            part(target, w.skills, ROADMAP_SKILLS, w.no_skills),
            part(z["gaps"], w.gaps, ROADMAP_GAPS, w.no_gaps),
            F.lit(w.plan),
            F.lit(w.questions_head),
            part(z["questions"], w.questions, ROADMAP_QUESTIONS, w.no_questions, numbered),
            F.lit(w.routine),
            F.concat(F.lit(w.closing), F.lit("**"), z["name"], F.lit("**.")),
        )

    def with_gaps(z: Column) -> Column:
        gaps = skill_gap(z["user"], z["target"])
        return bind({"name": name, "lists": z, "gaps": gaps, "roles": _items(similar_roles),
                     "questions": _items(sample_questions)}, body)

    return bind({"user": stripped(_items(user_skills)),
                 "target": stripped(_items(target_skills))}, with_gaps)


@dataclass(frozen=True)
class PromptWording:
    intro: str = "Act as a career adviser.\n\nRole wanted: "
    user: str = "\n\nSkills the person has: "
    target: str = "\n\nSkills that current postings ask for:\n"
    roles: str = "\n\nNeighbouring roles in the market:\n"
    questions: str = "\n\nTypical interview questions:\n"
    task: str = (
        "\n\nWrite, in markdown with headings and lists:\n"
        "1. the most important missing skills, grouped by field;\n"
        "2. a learning plan for three to six months with concrete steps;\n"
        "3. a few ways to meet people in this field;\n"
        "4. three related roles and why they fit."
    )
    no_user: str = "not specified"
    none: str = "N/A"


def prompt_text(role, user_skills, target_skills, similar_roles, sample_questions,
                wording: PromptWording = PromptWording()) -> Column:
    w = wording
    user, target = _items(user_skills), _items(target_skills)
    roles, questions = _items(similar_roles), _items(sample_questions)

    def joined(items: Column, most: int) -> Column:
        shown = F.array_join(F.slice(items, 1, most), ", ")
        return F.when(F.size(items) > 0, shown).otherwise(F.lit(w.none))

    known = F.array_join(F.array_sort(F.array_distinct(user)), ", ")
    return F.concat(
        F.lit(w.intro), F.coalesce(_col(role), F.lit("")),
        F.lit(w.user), F.when(F.size(user) > 0, known).otherwise(F.lit(w.no_user)),
        F.lit(w.target), joined(target, PROMPT_SKILLS),
        F.lit(w.roles), joined(roles, PROMPT_ROLES),
        F.lit(w.questions),
        F.when(F.size(questions) > 0, bullets(F.slice(questions, 1, PROMPT_QUESTIONS)))
         .otherwise(F.lit(w.none)),
        F.lit(w.task),
    )
