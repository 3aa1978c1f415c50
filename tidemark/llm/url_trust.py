"""URL filter: rules first, then trust carried over the link graph.

A rule names a host and the start of a path; it fits the host and all its subdomains, and the longest rule that
fits decides. A url without a fitting rule is judged by its host: trust starts at the hosts whose pages the
allow rules cover and follows links (personalised PageRank); distrust starts at the hosts whose pages the block
rules cover and follows links backwards, for a page that links to bad ones is suspect. Each seed's weight is the
share of its pages so covered. A host is blocked if distrust makes up more than ``threshold`` of both scores.

Edges are counted per pair of hosts before anything is joined, so neither a host with a third of all pages nor a
target of a third of all links puts its rows in one task. Links within a host and links without a host name
carry nothing to others and are left out; a host without edges keeps its own seed only, and what flows into it
goes back to the seeds. Rounds go on until no further host is reached and the scores of either kind change by less
than ``TOLERANCE`` in all: a host reached late has a small score, but it may be the only one it has.

Rows: a NULL url, or one without ``://``, has empty host and path, fits no rule and is judged like a host of its
own that has no links. NULL html has no links. Repeated rows are judged each and count each as a page. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import lower_ascii, written

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
TOLERANCE = 1e-6
# Rounds between two written tables, after each of which the change is measured.
ROUNDS_PER_TABLE = 4
THRESHOLD = 0.5
_LINKS = r"""(?i)(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    at = F.locate("://", url)
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def parse_rules(rules: list[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(rule, host, path, verdict), longest first; the path of a rule begins at its first slash."""
    parsed = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        parsed.append((rule, host.lower(), slash + path, verdict))
    return sorted(parsed, key=lambda r: (-len(r[0]), r[0]))


def with_rule(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``pages`` with host and path, and the rule and its verdict."""
    host, path = F.col("host"), F.col("path")
    chosen = F.lit(None).cast("struct<rule:string,ruled:string>")
    for rule, rule_host, rule_path, verdict in reversed(parse_rules(rules)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        named = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("ruled"))
        chosen = F.when(fits, named).otherwise(chosen)
    return pages.select("*", chosen.alias("_r")).select("*", "_r.rule", "_r.ruled").drop("_r")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): links from pages of one host to another host."""
    links = F.explode(F.regexp_extract_all(F.col("html"), F.lit(_LINKS), F.lit(1)))
    named = pages.where(F.col("html").contains("//")).select(F.col("host").alias("src"), links.alias("link"))
    target = host_of(F.concat(F.lit("http:"), F.regexp_replace("link", r"^[^/]*", "")))
    named = named.select("src", target.alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
    return named.groupBy("src", "dst").agg(F.count("*").alias("links"))


def flow(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, score): PageRank of two graphs at once, each from its own seeds.

    ``edges`` has (kind, src, dst, share) where the shares of a source add up to one, ``seeds`` (kind, host, seed)
    whose seeds add up to one per kind. What reaches a host without edges returns to the seeds.
    """
    state, reached, done = seeds.select("kind", "host", F.col("seed").alias("score")), None, 0
    while True:
        done += 1
        moved = edges.join(state.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * DAMPING).alias("part")
        )
        # What does not move on returns to the seeds: the undamped share, and all of a host without edges.
        kept = moved.groupBy("kind").agg(F.sum("part").alias("moved"))
        base = seeds.join(F.broadcast(kept), "kind", "left").select(
            "kind", "host", (F.col("seed") * (1 - F.coalesce("moved", F.lit(0.0)))).alias("part")
        )
        before, state = state, moved.unionByName(base).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        if done % ROUNDS_PER_TABLE:
            continue
        old = before.select("kind", "host", F.col("score").alias("old"))
        both = state.join(old, ["kind", "host"], "full_outer")
        state = written(both.select("kind", "host", F.coalesce("score", F.lit(0.0)).alias("score"), "old"), "flow")
        change = F.sum(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0)))).alias("change")
        now = {r["kind"]: r for r in state.groupBy("kind").agg(change, F.count("*").alias("hosts")).collect()}
        hosts = {kind: r["hosts"] for kind, r in now.items()}
        if hosts == reached and all(r["change"] < tolerance for r in now.values()):
            return state.drop("old")
        state, reached = state.drop("old"), hosts


def host_verdicts(judged: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, verdict) of every host that a seed or a flow reaches.

    ``judged`` has host, html and ruled for every page.
    """
    per_host = judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.sum(F.coalesce(F.col("ruled") == ALLOW, F.lit(False)).cast("double")).alias("n_allowed"),
        F.sum(F.coalesce(F.col("ruled") == BLOCK, F.lit(False)).cast("double")).alias("n_blocked"),
    )
    shares = F.inline(F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("n_allowed") / F.col("pages")).alias("weight")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("n_blocked") / F.col("pages")).alias("weight")),
    ))
    weights = written(per_host.select("host", shares).where("weight > 0"), "seeds")
    totals = weights.groupBy("kind").agg(F.sum("weight").alias("total"))
    seeds = weights.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("weight") / F.col("total")).alias("seed"))
    both = host_edges(judged).select(F.inline(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src"), F.col("dst"), F.col("links")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("links")),
    )))
    both = written(both, "links")
    if both.isEmpty():  # nothing flows: every score stays at its seed
        state = seeds.withColumnRenamed("seed", "score")
    else:
        out = both.groupBy("kind", "src").agg(F.sum("links").alias("out"))
        edges = written(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("out")).alias("share")), "shares")
        state = flow(edges, written(seeds, "seeds"), tolerance)

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)

    scores = state.groupBy("host").agg(of("trust"), of("distrust"))
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    return scores.withColumn("verdict", F.when(share > threshold, BLOCK).otherwise(ALLOW))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row."""
    url = F.col(url_col)
    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(path_of(url), F.lit("")).alias("path"), F.col(html_col).alias("html"),
    )
    ruled = with_rule(read, rules)
    hosts = host_verdicts(ruled, threshold, tolerance).withColumnRenamed("verdict", "host_verdict")
    # A third of the pages may name one host: the join's large side is one that Spark splits when it is skewed.
    joined = ruled.drop("html").join(hosts, "host", "left")
    return joined.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", "host_verdict", F.lit(ALLOW)).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
