"""URL rules, and trust that spreads over the links between hosts.

A rule decides the urls it fits.  For the others the host decides.  Two scores
start from the pages that rules decide: trust flows from hosts with allowed pages
along links, distrust flows from hosts with blocked pages against them, as
personalised PageRank.  A host whose distrust is above ``RATIO`` times its trust
is blocked.

Scores are whole numbers, so sums do not depend on the order of rows.  A page
counts as ``FINE`` units in decimals of 38 digits: a flow is lost only where it is
below 1e-20 of a page, and up to 1e11 pages that rules decide the sums fit; more
than fit raise an error.  Links are kept once per pair of hosts, degrees and flows
are sums combined before each shuffle, and every round is stored; nothing but one
sum per round reaches the driver.

Scores only grow from round to round, and what a round adds is at most ``DAMPING`` per
cent of what the one before has added.  Rounds go on until one adds less than
``TOLERANCE`` of a page to all scores together, so all that is left out adds less than
six times that.  That takes some 130 rounds on cycles, 30 more for every hundredfold of
pages, and as many as the longest path without any; a run that needs more than
``MOST_ROUNDS`` fails.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dimflow.llm.storage import Stored

DAMPING = 85  # per cent of a score that flows on
FINE = 10**20  # score of one page that a rule decides
TOLERANCE = 10**-9  # of a page
MOST_ROUNDS = 1000
SQL_ROUNDS = 40  # SQL cannot stop by itself
SCORE = "decimal(38,0)"
RATIO = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REST = r"(?s)^.*?://(.*)$"
HOST = r"^[^/?#]*"
PATH = r"^[^/?#]*([^?#]*)"
ANCHOR = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, REST, 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, HOST, 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.regexp_extract(url, REST, 1), PATH, 1), F.lit(""))


def best_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of its text and verdict.  Of rules
    of one length the first by text counts."""
    found = []
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found.append(F.when(fits, value))
    return F.coalesce(*found)


def host_links(pages: DataFrame, html: str, host: str) -> DataFrame:
    """Distinct links ``a`` to ``b`` between different hosts."""
    link = F.col("link")
    target = F.when(F.contains(link, F.lit("://")), host_of(link)).when(
        link.startswith("//"), host_of(F.concat(F.lit(":"), link))
    )
    return (
        pages.select(
            F.col(host).alias("a"), F.explode(F.regexp_extract_all(html, F.lit(ANCHOR), 1)).alias("link")
        )
        .select("a", target.alias("b"))
        .filter("a <> b AND a <> '' AND b <> ''")
        .distinct()
    )


def spread(seeds: DataFrame, links: DataFrame, held: Stored) -> DataFrame:
    """Scores per host and kind at rest, up to the tolerance.

    ``seeds``: host, kind, score.  Kind 0 is trust and flows along ``links``, kind
    1 is distrust and flows against them.
    """
    along = links.select(F.lit(0).alias("kind"), F.col("a").alias("from"), F.col("b").alias("to"))
    against = links.select(F.lit(1).alias("kind"), F.col("b").alias("from"), F.col("a").alias("to"))
    flows = held.keep(along.unionByName(against))
    degree = flows.groupBy("kind", "from").agg(F.count("*").alias("degree"))
    flows = held.keep(flows.join(degree, ["kind", "from"]))
    whole = seeds.withColumn("score", F.col("score").cast(SCORE))
    now, total = _stored(whole.select("host", "kind", _part("score", 100 - DAMPING).alias("score")), held)
    start, share = now, _floored(F.col("score") * DAMPING, 100 * F.col("degree"))
    for _ in range(MOST_ROUNDS):
        moved = (
            flows.join(now.withColumnRenamed("host", "from"), ["kind", "from"])
            .select(F.col("to").alias("host"), "kind", share.alias("score"))
        )
        after = start.unionByName(moved).groupBy("host", "kind").agg(_total("score").alias("score"))
        before = total
        now, total = _stored(after, held)
        if total - before <= TOLERANCE * FINE:
            return now
    raise RuntimeError(f"link scores still grow after {MOST_ROUNDS} rounds")


def _stored(scores: DataFrame, held: Stored) -> tuple[DataFrame, int]:
    """Scores in the shared folder, and their sum, which is taken as they are written."""
    seen = Observation()
    total = F.sum(F.col("score").cast("double"))
    kept = held.keep(scores.observe(seen, total.alias("total")))
    return kept, seen.get["total"] or 0


def _floored(score: Column, by: Column) -> Column:
    """Whole part of a quotient of decimals: ``div`` would give 64 bits."""
    by = by.cast("decimal(23,0)")
    return _sure(((score - score % by) / by).cast(SCORE))


def _part(column: str, per_cent: int) -> Column:
    return _floored(F.col(column) * per_cent, F.lit(100))


def _total(column: str) -> Column:
    return _sure(F.sum(column).cast(SCORE))


def _sure(score: Column) -> Column:
    """An overflow is an error in sessions that make it null, too."""
    return F.coalesce(score, F.raise_error(F.lit("a score exceeds 38 digits")).cast(SCORE))


def judge(
    pages: DataFrame, rules: list[Rule], held: Stored,
    key: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """One row per page: ``key``, ``host``, ``path``, ``rule`` and ``verdict``.

    A null url, or one without ``://``, has an empty host and path; no link leaves
    or reaches the empty host.  Links without a host stay on their page's host and
    carry nothing.  A null page has no links.  A host without any score is allowed.
    Repeated rows each give a row and count as pages.  Other columns are ignored;
    an empty table gives no rows.
    """
    placed = pages.select(
        F.col(key).alias("key"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.col(html).alias("html"),
    )
    links = host_links(placed, "html", "host")
    judged = placed.drop("html").withColumn("best", best_rule(rules, F.col("host"), F.col("path")))
    kind = F.when(F.col("best.verdict") == "allow", 0).otherwise(1).alias("kind")
    seeds = (
        judged.filter("best IS NOT NULL")
        .groupBy("host", kind)
        .agg((F.count("*").cast(SCORE) * F.lit(str(FINE)).cast(SCORE)).cast(SCORE).alias("score"))
    )
    scores = spread(seeds, links, held)
    of_kind = [F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0)) for k in (0, 1)]
    bad_hosts = (
        scores.groupBy("host")
        .agg(of_kind[0].alias("trust"), of_kind[1].alias("distrust"))
        .filter(F.col("distrust") > RATIO * F.col("trust"))
        .select("host", F.lit("block").alias("of_host"))
    )
    return judged.join(bad_hosts, "host", "left").select(
        "key",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "of_host", F.lit("allow")).alias("verdict"),
    )


def judge_sql(rules: list[Rule]) -> str:
    """The same in SQL, by the same whole numbers, with one subquery per round."""
    best = " ".join(
        f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{r.verdict} {r.text}'"
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    )
    anchor = ANCHOR.replace("'", "''")
    rounds = "".join(
        f""", s{i + 1} AS MATERIALIZED (
        SELECT host, kind, sum(score)::HUGEINT AS score FROM (
            SELECT * FROM s0 UNION ALL
            SELECT f.b, f.kind, s.score * {DAMPING} // (100 * f.degree)
            FROM s{i} s JOIN flows f ON f.kind = s.kind AND f.a = s.host
        ) GROUP BY host, kind)"""
        for i in range(SQL_ROUNDS)
    )
    return f"""
    WITH split AS (
        SELECT page_id, html, coalesce(regexp_extract(url, '{REST}', 1), '') AS rest FROM pages
    ), placed AS (
        SELECT page_id, html, regexp_extract(rest, '{PATH}', 1) AS path,
            translate(regexp_extract(rest, '{HOST}', 0), '{UPPER}', '{LOWER}') AS host
        FROM split
    ), judged AS (
        SELECT page_id, host, path, CASE {best} END AS best FROM placed
    ), linked AS (
        SELECT host AS a, unnest(regexp_extract_all(html, '{anchor}', 1)) AS link FROM placed
    ), targets AS (
        SELECT a, CASE WHEN contains(link, '://') THEN regexp_extract(link, '{REST}', 1)
            WHEN starts_with(link, '//') THEN regexp_extract(':' || link, '{REST}', 1) END AS rest
        FROM linked
    ), links AS (
        SELECT DISTINCT a, b FROM (
            SELECT a, translate(regexp_extract(rest, '{HOST}', 0), '{UPPER}', '{LOWER}') AS b
            FROM targets) WHERE a <> b AND a <> '' AND b <> ''
    ), both_ways AS (
        SELECT 0 AS kind, a, b FROM links UNION ALL SELECT 1, b, a FROM links
    ), flows AS MATERIALIZED (
        SELECT *, count(*) OVER (PARTITION BY kind, a) AS degree FROM both_ways
    ), s0 AS MATERIALIZED (
        SELECT host, CASE WHEN best LIKE 'allow %' THEN 0 ELSE 1 END AS kind,
            count(*)::HUGEINT * {FINE // 100} * {100 - DAMPING} AS score
        FROM judged WHERE best IS NOT NULL GROUP BY ALL
    ){rounds}, bad AS (
        SELECT host FROM s{SQL_ROUNDS} GROUP BY host
        HAVING sum(CASE WHEN kind = 1 THEN score ELSE 0 END)
            > {RATIO} * sum(CASE WHEN kind = 0 THEN score ELSE 0 END)
    )
    SELECT page_id, host, path, substr(best, strpos(best, ' ') + 1) AS rule,
        CASE WHEN best IS NOT NULL THEN substr(best, 1, strpos(best, ' ') - 1)
            WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
    FROM judged
    """
