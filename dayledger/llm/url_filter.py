"""URL filtering by rules and by link-graph propagation, in DataFrame operations only.

Rules decide the urls they fit. They also name the seeds: a host is trusted by the share of its pages
that a rule allows, and blocked by the share that a rule blocks. Trust flows along links from host to
host (personalised PageRank from the trusted seeds); distrust flows against them (from a blocked host
to those that link to it). Both count in units of what one wholly trusted or blocked host has of its own,
so hosts without a path to a host do not change its verdict. A host whose distrust reaches ``threshold``
and exceeds its trust is blocked, and its verdict holds for all urls no rule fits. Rounds go on until what
could still move is below ``LEFT`` of the seeds, or nothing moves.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is allowed;
null html has no links; repeated pages are judged alike and add to the weight of their links; without
links or seeds every remaining url is allowed; empty input gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import UPPER, stored

#: (host, path, verdict); a rule fits its host and all subdomains where the path starts with its path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Links as they stand in html: a href with a scheme, or one that starts with two slashes.
LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'>]+)"""
#: Share of the seeds that rounds may leave unsent.
LEFT = 0.01


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict``: those of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, weight`` of links between different hosts; weight is their number."""
    found = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("href")) \
        .select(F.col("host").alias("src"), host_of(F.concat(F.lit(":"), "href")).alias("dst"))
    return found.filter("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def rounds_for(damping: float, left: float = LEFT) -> int:
    """Rounds after which ``damping ** rounds`` of the seeds, at most, has not been sent on."""
    return math.ceil(math.log(left) / math.log(damping))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float) -> DataFrame:
    """Personalised PageRank of ``host, seed`` along ``src, dst, part`` (parts of a source sum to 1).
    Contributions to a host are summed before the shuffle, and every round is written and read back.
    Without an edge that leaves a host with a score, no further round changes anything."""
    score = seeds.select("host", F.col("seed").alias("score"))
    for _ in range(rounds):
        sent = edges.join(score, F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"), (damping * F.col("part") * F.col("score")).alias("score"))
        home = seeds.select("host", ((1 - damping) * F.col("seed")).alias("score"))
        after = stored(sent.unionByName(home).groupBy("host").agg(F.sum("score").alias("score")))
        both = after.join(score.withColumnRenamed("score", "was"), "host", "full").na.fill(0.0)
        moved = both.agg(F.max(F.abs(F.col("score") - F.col("was")))).first()[0]
        score = after
        if not moved:
            break
    return score


def judge(pages: DataFrame, rules=RULES, rounds: int | None = None, damping: float = 0.85, threshold: float = 0.02) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    rows = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = stored(ruled(rows.select("page_id", "host", "path"), rules))
    links = stored(host_links(rows))
    share = lambda said: F.avg(F.when(F.col("rule_verdict") == said, 1.0).otherwise(0.0))
    hosts = judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block"))

    flows = []
    for name, seed, src, dst in (("trust", "allow", "src", "dst"), ("distrust", "block", "dst", "src")):
        out = links.groupBy(F.col(src).alias("__from")).agg(F.sum("weight").alias("out"))
        edges = stored(links.select(F.col(src).alias("__from"), F.col(dst).alias("__to"), "weight").join(out, "__from").select(
            F.col("__from").alias("src"), F.col("__to").alias("dst"), (F.col("weight") / F.col("out")).alias("part")))
        seeds = stored(hosts.filter(F.col(seed) > 0).select("host", F.col(seed).alias("seed")))
        score = propagate(edges, seeds, rounds or rounds_for(damping), damping)
        flows.append(score.select("host", (F.col("score") / (1 - damping)).alias(name)))
    known = flows[0].join(flows[1], "host", "full").na.fill(0.0)
    found = judged.join(stored(known), "host", "left").na.fill(0.0, ["trust", "distrust"])
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return found.select("page_id", "host", "path", "rule",
                        F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


def sql(rules=RULES, rounds: int | None = None, damping: float = 0.85, threshold: float = 0.02) -> str:
    """The same judgement as SQL over the view ``pages``, one common table a round."""
    host = r"translate(regexp_extract({u}, '^[\s\S]*?://([^/?#]*)', 1), '" + UPPER + "', '" + UPPER.lower() + "')"
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = ["(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')".format(*r) for r in longest]
    case = lambda value: "CASE " + " ".join(f"WHEN {f} THEN '{value(r)}'" for f, r in zip(fits, longest)) + " END"
    link = LINK.replace("(?i)", "").replace("'", "''")
    parts = [
        f"u AS (SELECT page_id, html, COALESCE({host.format(u='url')}, '') AS host, COALESCE(regexp_extract(url, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)",
        f"j AS (SELECT page_id, host, path, {case(lambda r: r[0] + r[1])} AS rule, {case(lambda r: r[2])} AS said FROM u)",
        f"x AS (SELECT host, unnest(regexp_extract_all(html, '{link}', 1, 'i')) AS href FROM u)",
        f"l AS (SELECT host AS src, {host.format(u="':' || href")} AS dst, count(*) AS weight FROM x GROUP BY ALL HAVING src <> dst AND src <> '' AND dst <> '')",
        "h AS (SELECT host, avg((said IS NOT DISTINCT FROM 'allow')::INT) AS allow, avg((said IS NOT DISTINCT FROM 'block')::INT) AS block FROM j WHERE host <> '' GROUP BY 1)",
    ]
    for name, seed, src, dst in (("t", "allow", "src", "dst"), ("d", "block", "dst", "src")):
        parts.append(f"{name}e AS (SELECT {src} AS src, {dst} AS dst, weight / sum(weight) OVER (PARTITION BY {src}) AS part FROM l)")
        parts.append(f"{name}0 AS (SELECT host, {seed} AS score FROM h WHERE {seed} > 0)")
        for k in range(rounds or rounds_for(damping)):
            parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT host, sum(score) AS score FROM ("
                         f"SELECT dst AS host, {damping} * part * score AS score FROM {name}e JOIN {name}{k} ON src = host"
                         f" UNION ALL SELECT host, {1 - damping} * score FROM {name}0) GROUP BY 1)")
        parts.append(f"{name} AS (SELECT host, score / {1 - damping} AS score FROM {name}{rounds or rounds_for(damping)})")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT page_id, j.host, path, rule, COALESCE(said, CASE WHEN COALESCE(d.score, 0) >= {threshold}
       AND COALESCE(d.score, 0) > COALESCE(t.score, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN t ON t.host = j.host LEFT JOIN d ON d.host = j.host""")
