"""Job plans: by tier, by domain, and balanced by activity.

Membership stays rows (one per entity with its job); lists are only built for groups whose size
is capped by the plan itself.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rowtide.functions.measures import TIERS
from rowtide.operators.activity import CATEGORY, TOTAL, totals_by
from rowtide.operators.ranking import RANGE, Desc, Ranges, chunk_groups, ranked
from rowtide.session import pinned

# Name patterns a domain is read from, tried in order; and the fallback domain.
CAPITALS_PREFIX = "^([A-Z]{2,})[A-Z][a-z]"
CAPITALS_ONLY = "^([A-Z]{2,})\\z"
FIRST_WORD = "^([A-Z][a-z]+)"
NO_DOMAIN = "misc"
SINGLES_DOMAIN = "medium_misc"
MAX_TABLES_PER_JOB = 10


def extract_domain(name: Column) -> Column:
    """Domain of a name: its capitals prefix, else its first word, else ``misc``; in lower case."""
    found = [F.nullif(F.regexp_extract(name, p, 1), F.lit("")) for p in (CAPITALS_PREFIX, CAPITALS_ONLY, FIRST_WORD)]
    return F.lower(F.coalesce(*found, F.lit(NO_DOMAIN)))


def with_tier_job(activity: DataFrame, schema: str, entity: str) -> DataFrame:
    """Each entity's job: one of its own if high, the shared bundle of its tier otherwise."""
    high = F.col(CATEGORY) == "high"
    own = F.concat_ws("_", F.col(schema), F.col(entity))
    bundle = F.concat(F.col(schema), F.lit("_"), F.col(CATEGORY), F.lit("_io_bundle"))
    job = F.when(high, own).otherwise(bundle)
    return activity.withColumns(
        {
            "job_name": job,
            "job_file": F.concat(job, F.lit("_config.yaml")),
            "job_category": F.when(high, "high").otherwise("bundle"),
        }
    )


def plan_by_tier(activity: DataFrame, schema: str, entity: str) -> DataFrame:
    """Jobs with their totals. Sums combine before the shuffle, so a huge bundle is no hot spot."""
    return totals_by(with_tier_job(activity, schema, entity), ["job_name", "job_file", "job_category"])


def table_to_job(entities: DataFrame, plan: DataFrame, entity: str) -> DataFrame:
    """Each entity with its job from a plan of membership rows; null where it has none."""
    return entities.join(plan.select(entity, "job_name"), entity, "left")


def group_by_domain(entities: DataFrame, entity: str, max_size: int = MAX_TABLES_PER_JOB) -> DataFrame:
    """Entities with their ``group_name``: domains of two or more stay together, the rest is pooled.

    Groups are cut, in name order, to ``max_size`` members.
    """
    domains = entities.withColumn("domain", extract_domain(F.col(entity)))
    sized = ranked(domains, ["domain"], [entity], rank="_rn", size="_size")
    pooled = F.when(F.col("_size") > 1, F.col("domain")).otherwise(SINGLES_DOMAIN)
    sized = sized.withColumn("_pool", pooled)
    shared = sized.where(F.col("_size") > 1).withColumn(
        "group_no", F.call_function("div", F.col("_rn") - 1, F.lit(max_size)) + 1
    )
    singles = chunk_groups(sized.where(F.col("_size") == 1).drop("_rn"), ["_pool"], [entity], max_size)
    both = shared.drop("_rn").unionByName(singles)
    name = F.concat(F.col("_pool"), F.lit("_group"), F.col("group_no").cast("string"))
    return both.withColumn("group_name", name).drop("_size", "_pool", "group_no")


def group_members(grouped: DataFrame, entity: str, group: str = "group_name") -> DataFrame:
    """Sorted member list per group; only for groups capped in size, as :func:`group_by_domain` makes."""
    return grouped.groupBy(group).agg(F.array_sort(F.collect_list(entity)).alias("members"))


def union_tiers(activity: DataFrame, schema: str, entity: str) -> DataFrame:
    """Membership rows of the high, medium and low jobs put together, in one pass over the entities."""
    return with_tier_job(activity.where(F.col(CATEGORY).isin(*TIERS)), schema, entity)


def union_job_outputs(outputs: dict[str, DataFrame]) -> DataFrame:
    """Rows of several jobs in one frame, tagged by job."""
    out = None
    for job, df in outputs.items():
        part = df.withColumn("job", F.lit(job))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _heaviest_first(amounts: list[int], jobs: int) -> tuple[list[int], list[int]]:
    """Each amount, in order, to the job with the least so far; the jobs and their loads."""
    loads = [(0, j) for j in range(jobs)]
    given = []
    for amount in amounts:
        load, j = heapq.heappop(loads)
        given.append(j)
        heapq.heappush(loads, (load + amount, j))
    return given, [load for load, _ in sorted(loads, key=lambda x: x[1])]


def _water_level(loads: list[int], rest: int) -> list[int]:
    """How much of ``rest`` each job takes so that the lowest loads rise to one level."""
    order = sorted(range(len(loads)), key=loads.__getitem__)
    room, level, filled = [0] * len(loads), 0, 0
    for k, j in enumerate(order, 1):
        filled += loads[j]
        level = -(-(rest + filled) // k)
        if k == len(order) or level <= loads[order[k]]:
            break
    for j in order[:k]:
        room[j] = max(0, level - loads[j])
    return room


def balanced_by_amount(activity: DataFrame, entity: str, jobs: int, metric: str = TOTAL, head: int | None = None) -> DataFrame:
    """Spread entities over jobs by their amounts: adds ``job_no`` (from 1).

    The ``head`` heaviest (64 a job unless given; they come to the driver) go one by one to the job with the least so far. All others, each
    lighter than those, fill the jobs up to one level in the order of their name, by running sums over ranges, so any number of them is
    spread. The heaviest job has at most 4/3 of the least possible. A null or negative amount counts as 0.
    """
    head = head or 64 * jobs
    sized = activity.withColumn("_amount", F.greatest(F.coalesce(F.col(metric), F.lit(0)), F.lit(0)).cast("bigint"))
    heavy = pinned(sized.select(entity, "_amount").orderBy(F.desc("_amount"), F.asc_nulls_first(entity)).limit(head))
    rows = heavy.orderBy(F.desc("_amount"), F.asc_nulls_first(entity)).collect()
    given, loads = _heaviest_first([r["_amount"] for r in rows], jobs)
    placed = activity.sparkSession.createDataFrame([(r[entity], j + 1) for r, j in zip(rows, given)], StructType([heavy.schema[entity], StructField("_job", IntegerType())]))
    placed = placed.withColumnRenamed(entity, "_entity")
    marked = sized.join(F.broadcast(placed), sized[entity].eqNullSafe(placed["_entity"]), "left").drop("_entity")
    tail = marked.where("_job is null")
    ranges = Ranges(tail, [], [entity, "_amount"])
    sums = pinned(ranges.keys.groupBy(RANGE).agg(F.sum("_amount").alias("_sum")))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    heads = sums.select(RANGE, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy(RANGE).orderBy(F.asc_nulls_first(entity), "_amount").rowsBetween(Window.unboundedPreceding, -1)
    run = tail.withColumn(RANGE, ranges.number)
    run = ranges.with_shared(run.withColumn("_own", F.coalesce(F.sum("_amount").over(inside), F.lit(0))), heads)
    room = _water_level(loads, sums.agg(F.coalesce(F.sum("_sum"), F.lit(0))).first()[0])
    ends = list(accumulate(room))
    at, job = F.col("_earlier") + F.col("_own"), F.lit(jobs)
    for j in range(jobs - 1, 0, -1):  # nested, as a job has one interval of the running sum
        job = F.when(at < ends[j - 1], j).otherwise(job)
    done = marked.where("_job is not null").select(*activity.columns, F.col("_job").cast("bigint").alias("job_no"))
    return done.unionByName(run.select(*activity.columns, job.cast("bigint").alias("job_no")))


def balanced_plan(activity: DataFrame, entity: str, jobs: int, metric: str = TOTAL) -> DataFrame:
    """Spread entities over jobs by activity: ranked busiest first, dealt out forth and back."""
    numbered = ranked(activity, [], [Desc(metric), entity], rank="activity_rank")
    place = F.pmod(F.col("activity_rank") - 1, F.lit(2 * jobs))
    job = F.when(place < jobs, place).otherwise(2 * jobs - 1 - place)
    return numbered.withColumn("job_no", (job + 1).cast("bigint"))
