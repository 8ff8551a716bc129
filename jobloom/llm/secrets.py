"""Secrets in texts, judged by how widely each value is owned across the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.words import attached, known
from jobloom.session import checkpoint

# The three kinds, in order. A match is dropped when its value is shorter than
# the least length; only for ``assign`` can a failing match hide a later one, so only there is
# the length tested after matching.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24)}
NAMES = [*KINDS, "live"]

EXAMPLE_OWNERS = 3         # a value that so many owners hold is a copied example,
EXAMPLE_REPOSITORIES = 10  # and so is one in so many repositories, whoever owns them
LIVE_SYMBOLS = 8     # a live-looking value has at least so many different characters

_SPAN = "struct<start:long,kind:int,stop:long,value_start:long,hash:string,mixed:boolean>"


def _looks_random(value: Column) -> Column:
    """Letters and digits together, and enough different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_SYMBOLS))


def _spans(text: Column, kind: str) -> Column:
    """array<_SPAN> of one kind: leftmost matches, those with too short a value left out.

    The pieces between the matches give the places: a match starts after all earlier pieces
    and matches. Lengths are in code points.
    """
    pattern, group, least = KINDS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))
    found = F.arrays_zip(F.transform(matches, lambda m: F.length(m).cast("long")).alias("m"),
                         values.alias("v"), F.slice(gaps, 1, F.size(matches)).alias("g"))

    def add(state, x):
        start = state["at"] + x["g"]
        stop = start + x["m"]
        span = F.struct(
            start.alias("start"), F.lit(NAMES.index(kind)).alias("kind"), stop.alias("stop"),
            (stop - F.length(x["v"])).alias("value_start"), F.sha2(x["v"], 256).alias("hash"),
            _looks_random(x["v"]).alias("mixed"))
        fits = F.length(x["v"]) >= least
        return F.struct(stop.alias("at"), F.when(fits, F.concat(
            state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    empty = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast(f"array<{_SPAN}>").alias("spans"))
    all_ = F.aggregate(found, empty, add, lambda s: s["spans"])
    return F.when(text.rlike(pattern), all_).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _written(spans: Column) -> Column:
    """kind:start:stop of every span, comma-joined."""
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """Per document: _id, _text (a hash that tells apart rows with one id), _owner, _repo, and
    the base spans ordered by start, then kind. Values leave only as SHA-256."""
    text = known(F.col(text_col))
    found = F.concat(*[_spans(text, kind) for kind in KINDS])
    return docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"),
        F.col(owner_col).cast("string").alias("_owner"),
        F.col(repository_col).cast("string").alias("_repo"),
        F.array_sort(found).alias("_base"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories: in how many different owners and repositories each value
    stands. Counted in three pre-aggregated steps, so that one value that stands in a third
    of all documents never meets in one task as rows."""
    each = found.filter(F.size("_base") > 0).select(
        "_owner", "_repo", F.explode(F.array_distinct(F.transform(
            "_base", lambda s: s["hash"]))).alias("hash"))
    repos = each.groupBy("hash", "_owner", "_repo").agg(F.lit(1).alias("_one"))
    owners = repos.groupBy("hash", "_owner").agg(F.sum("_one").alias("_repos"))
    return owners.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("_repos").alias("repositories"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example, most_owners, most_repositories.

    ``spans`` holds the base spans and, for every value that looks random and is neither held by
    ``EXAMPLE_OWNERS`` owners nor found in ``EXAMPLE_REPOSITORIES`` repositories, a ``live`` span
    over the value itself. ``n_example`` counts the base spans whose value is a widely copied
    example; the last two columns are the largest counts of the document's values (without
    values 0). Null text counts as empty (no spans); a null owner is one owner, a null
    repository one repository; rows that repeat id and text give equal rows; an empty table
    gives none.
    """
    found = checkpoint(candidates(docs, id_col, text_col, owner_col, repository_col))
    wide = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    stats = checkpoint(ownership(found).withColumn("_wide", wide))
    keys = found.filter(F.size("_base") > 0).select(
        "_id", "_text", F.explode("_base").alias("s")).distinct().select(
        "_id", "_text", "s", F.col("s.hash").alias("hash"))
    total = stats.agg(F.coalesce(F.sum("repositories"), F.lit(0))).first()[0]
    judged = attached(keys, stats, ["hash"], "repositories", total)
    live = F.struct(
        F.col("s.value_start").alias("start"), F.lit(NAMES.index("live")).alias("kind"),
        F.col("s.stop").alias("stop"))
    per_doc = judged.groupBy("_id", "_text").agg(
        F.collect_set(F.when(~F.col("_wide") & F.col("s.mixed"), live)).alias("_live"),
        F.count_if("_wide").alias("_examples"), F.max("owners").alias("_owners"),
        F.max("repositories").alias("_repos"))
    per_doc = per_doc.select(F.col("_id").alias("_id2"), F.col("_text").alias("_text2"),
                             "_live", "_examples", "_owners", "_repos")
    with_any = found.filter(F.size("_base") > 0).join(
        per_doc, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text") == F.col("_text2")))
    none = found.filter(F.size("_base") == 0).withColumns({
        "_live": F.array().cast("array<struct<start:long,kind:int,stop:long>>"),
        **{c: F.lit(0).cast("long") for c in ("_examples", "_owners", "_repos")}})
    rows = with_any.select(*none.columns).unionByName(none)
    short = F.transform("_base", lambda s: F.struct(s["start"], s["kind"], s["stop"]))
    base = _written(F.col("_base"))
    kinds = F.transform("_base", lambda s: s["kind"])
    count = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long")
             for i, k in enumerate(KINDS)}
    return rows.select(
        F.col("_id").alias(id_col), *[c.alias(n) for n, c in count.items()],
        F.sha2(base, 256).alias("base_sha256"),
        _written(F.array_sort(F.concat(short, F.col("_live")))).alias("spans"),
        F.size("_live").cast("long").alias("n_live"), F.col("_examples").alias("n_example"),
        F.col("_owners").alias("most_owners"), F.col("_repos").alias("most_repositories"))


def _sql() -> str:
    """The same scan in SQL: pieces between matches give the places."""
    kinds = " union all ".join(
        f"select doc_id, source, {i} as kind, string_split_regex(t, p) as gaps, "
        f"regexp_extract_all(t, p, 0) as found, regexp_extract_all(t, p, {group}) as vals, "
        f"{least} as least from (select *, '{pattern}' as p from d)"
        for i, (pattern, group, least) in enumerate(KINDS.values()))
    names = ", ".join(f"'{n}'" for n in NAMES)
    counts = ", ".join(f"cast(count(*) filter (kind = {i}) as bigint) as n_{k}"
                       for i, k in enumerate(KINDS))
    return rf"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
k as ({kinds}),
s as (
  select doc_id, source, kind, least, vals[i] as val,
    coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as start,
    length(found[i]) as n
  from (select *, unnest(range(1, len(found) + 1)) as i from k)),
base as (select *, start + n as stop from s where length(val) >= least),
owners as (select val, count(distinct coalesce(source, chr(0))) as owners,
    count(distinct coalesce(source, chr(0)) || chr(1) || coalesce(cast(doc_id as varchar), chr(0)))
      as repositories,
    owners >= {EXAMPLE_OWNERS} or repositories >= {EXAMPLE_REPOSITORIES} as wide
  from base group by val),
judged as (select b.*, owners, repositories, wide, not wide and regexp_matches(val, '[0-9]')
    and regexp_matches(val, '[A-Za-z]')
    and len(list_distinct(string_split(val, ''))) >= {LIVE_SYMBOLS} as live
  from base b join owners using (val)),
spans as (
  select doc_id, start, kind, stop from judged
  union all select distinct doc_id, stop - length(val), {NAMES.index("live")}, stop
  from judged where live),
written as (
  select doc_id, string_agg(list_extract([{names}], kind + 1) || ':' || cast(start as bigint)
      || ':' || cast(stop as bigint), ',' order by start, kind, stop) as spans,
    cast(count(*) filter (kind = {NAMES.index("live")}) as bigint) as n_live
  from spans group by doc_id),
counted as (
  select doc_id, {counts}, cast(count(*) filter (wide) as bigint) as n_example,
    cast(max(owners) as bigint) as most_owners, cast(max(repositories) as bigint) as most_repositories,
    string_agg(list_extract([{names}], kind + 1) || ':' || cast(start as bigint) || ':'
      || cast(stop as bigint), ',' order by start, kind) as base
  from judged group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in KINDS)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
  coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example,
  coalesce(most_owners, 0) as most_owners, coalesce(most_repositories, 0) as most_repositories
from d left join counted using (doc_id) left join written using (doc_id)
"""


SQL = _sql()
