"""URL verdicts: host and path rules, and a logistic regression on hashed character n-grams (native)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.tables import ascii_lower, let, stored

#: (verdict, host, path): fixed values of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Labelled hosts of the default training table; each is met with several sections below.
UNWANTED = """casino-win free-bets cheap-pills online-casino-bonus best-slots poker-jackpot bet-now win-money free-spins
buy-pills-online pharma-discount cheap-meds viagra-shop fast-loans payday-loan-now xxx-videos adult-cams hot-singles
ad-tracker spam-links link-farm adult-zone free-iphone-winner crypto-doubler get-rich-quick replica-watches lottery-prize torrent-cracks keygen-serials""".split()
WANTED = """library museum-archive open-docs city-council daily-news science-journal university weather garden-notes
history-society recipes travel-diary code-blog music-school health-service parliament encyclopedia film-review
bookshop sports-club railway-times law-reports hospital language-lessons the-thing farm-market""".split()
SECTIONS = ("/en/17", "/de/204.html", "/fr/3381/", "/es/55?page=2&ref=x", "/")


def labelled_urls(spark) -> DataFrame:
    """The small labelled table: url, label (1: block). Every host stands in it with several sections and prefixes."""
    rows = []
    for label, hosts in ((1, UNWANTED), (0, WANTED)):
        for i, host in enumerate(hosts):
            for j, section in enumerate(SECTIONS):
                front = ("", "www.", "m.", "blog.")[(i + j) % 4]
                top = ("com", "org", "net")[(i + j) % 3]
                rows.append(f"('http://{front}{host}.example.{top}{section}', {label})")
    return spark.sql("select url, cast(label as double) as label from values " + ", ".join(rows) + " as t(url, label)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an URL; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(found, pattern, 1)), F.regexp_extract(found, pattern, 2)


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, written host then path, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def gram_slots(host: Column, path: Column, slots: int, sizes: tuple[int, ...]) -> Column:
    """Distinct hash slots of the character n-grams of host and path; linear in the URL's length."""

    def grams(chars: Column, n: int) -> Column:
        last = F.size(chars) - n
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.pmod(F.xxhash64(*[F.get(chars, i + k) for k in range(n)]), F.lit(slots)).cast("int"))

    def all_grams(text: Column) -> Column:
        return let(F.split(text, ""), lambda chars: F.concat(*[grams(chars, n) for n in sizes]))

    return F.array_distinct(F.concat(all_grams(F.concat(F.lit("^"), host, F.lit("$"))), all_grams(F.concat(F.lit(">"), path))))


def trained_weights(labelled: DataFrame, slots: int, sizes: tuple[int, ...], max_rows: int = 5000) -> list[float]:
    """Weights per slot, then the intercept, of a logistic regression on at most ``max_rows`` labelled URLs (by hash)."""
    few = labelled.where("label is not null and url is not null").orderBy(F.xxhash64("url"), "label").limit(max_rows)
    found = gram_slots(*host_and_path(F.col("url")), slots, sizes)
    dense = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda i: F.when(F.array_contains(F.col("_s"), i.cast("int")), 1.0).otherwise(0.0))
    slotted = stored(few.select("label", found.alias("_s")), "labelled")  # else the slots would be found anew for each of them
    rows = slotted.select("label", array_to_vector(dense).alias("features"))
    model = LogisticRegression(regParam=0.002, maxIter=60, standardization=False).fit(rows)
    return [float(x) for x in model.coefficients.toArray()] + [float(model.intercept)]


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, slots: int = 2048, sizes: tuple[int, ...] = (3, 4), cut: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and ``p_block`` per row of ``pages`` (page_id, url).

    A fitting rule decides; else the model blocks where its probability of ``block`` reaches ``cut``. Null
    URLs and those without ``://`` have empty host and path and are judged by the model. The weights (one per slot,
    a fixed number) travel inside the plan; no row leaves its task. An empty table gives no rows.
    """
    weights = trained_weights(labelled, slots, sizes)
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    table = F.split(F.lit(",".join(f"{w:.6g}" for w in weights[:-1])), ",").cast("array<double>")
    found = gram_slots(F.col("host"), F.col("path"), slots, sizes)
    z = F.aggregate(found, F.lit(weights[-1]), lambda a, i: a + F.get(table, i))
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    scored = parts.withColumn("p_block", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    decided = F.coalesce(verdict, F.when(F.col("p_block") >= cut, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", rule.alias("rule"), decided.alias("verdict"), "p_block")
