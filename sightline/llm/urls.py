"""URL filters that follow redirects: aliases of a blocked page are blocked, unless a rule allows them.

Rules judge a page by host and path. Redirects and canonical links join URLs
into groups of aliases, found as connected components; a page that no rule
names takes the verdict of its group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import components, lower_ascii

# (host, path prefix, verdict) of the registered query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

# Up to so many rules are part of the plan; longer lists become a table that is joined.
PLAN_RULES = 256

HIT = "struct<length:int,rule:string,verdict:string>"

_TAG = r"(?is)<{name}\b[^>]*>"
_ATTRIBUTE = r"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (length, rule, verdict), or null.

    A rule fits its host and all subdomains where the path starts with the
    rule's. Of two rules of one length the later in code point order wins.
    """
    hits = [
        F.when(
            ((host == F.lit(h)) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array(F.lit(None).cast(HIT), *hits))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table (host, path, verdict)."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def suffixes(host: Column) -> Column:
    """The host itself and what follows each of its dots."""
    parts = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, n, F.size(parts)), ".")
    )


def joined_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, hit) of the distinct (host, path) that any rule fits; ``hit`` is that of :func:`matching_rule`.

    ``rules`` is a table (host, path, verdict) of any length; rules with a null
    are left out. A place meets the rules on equality: every suffix of its host
    first learns which lengths the paths of that host's rules have, and its path
    is cut to these lengths. So a place makes rows for its suffixes and their
    lengths, and not for all the rules of a host.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"]).select("host", "path", "verdict")
    own = F.struct(
        F.char_length(F.concat("host", "path")).alias("length"), F.concat("host", "path").alias("rule"), "verdict"
    )
    # One verdict for each host and path, so that repeated rules make no rows.
    best = rules.groupBy(F.col("host").alias("_suffix"), F.col("path").alias("_prefix")).agg(F.max(own).alias("_hit"))
    lengths = best.groupBy("_suffix").agg(F.collect_set(F.char_length("_prefix")).alias("_lengths"))
    known = places.select("host", "path").distinct()
    cut = known.select("*", F.explode(suffixes(F.col("host"))).alias("_suffix")).join(lengths, "_suffix")
    fitting = F.filter("_lengths", lambda n: n <= F.char_length("path"))
    cut = cut.select("host", "path", "_suffix", F.explode(fitting).alias("_n"))
    cut = cut.withColumn("_prefix", F.substring("path", F.lit(1), F.col("_n")))
    return cut.join(best, ["_suffix", "_prefix"]).groupBy("host", "path").agg(F.max("_hit").alias("hit"))


def with_hits(places: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Rows with (host, path) and ``hit``, the longest rule that fits or null."""
    if not isinstance(rules, DataFrame):
        if len(rules) <= PLAN_RULES:
            return places.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
        rules = rule_table(places.sparkSession, rules)
    return places.join(joined_rules(places, rules), ["host", "path"], "left")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute without its quotes, entities for & read; empty if absent."""
    value = F.regexp_extract(tag, _ATTRIBUTE.format(name=name), 1)
    value = F.regexp_replace(value, r"""(?s)^["']|["']$""", "")
    return F.trim(F.replace(value, F.lit("&amp;"), F.lit("&")))


def _absolute(link: Column, base: Column) -> Column:
    """A link against the page's URL; links of other kinds than web addresses become null."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*[^?#]*/|.*?://[^/?#]*)", 1)
    return (
        F.when((link == "") | link.startswith("#"), F.lit(None))
        .when(link.rlike(r"(?i)^https?://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), link))
    )


def without_fragment(url: Column) -> Column:
    """The URL as a node of the graph: without what follows ``#``, the host in lower case."""
    plain = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    rest = F.regexp_extract(plain, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    scheme = F.regexp_extract(plain, r"(?s)^(.*?)://", 1)
    return F.when(F.instr(plain, "://") > 0, F.concat(lower_ascii(scheme), F.lit("://"), host_of(plain), rest)).otherwise(plain)


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): a page's URL and the target of its canonical link or refresh; only pages with such tags give rows.

    Links are read against the page's own URL; a ``base`` tag is not followed.
    """
    # What a comment holds is no tag.
    html = F.regexp_replace("html", r"(?s)<!--.*?(-->|\z)", "")
    links = F.filter(
        F.regexp_extract_all(html, F.lit(_TAG.format(name="link")), F.lit(0)),
        lambda t: F.concat(F.lit(" "), lower_ascii(_attribute(t, "rel")), F.lit(" ")).rlike(r"\scanonical\s"),
    )
    metas = F.filter(
        F.regexp_extract_all(html, F.lit(_TAG.format(name="meta")), F.lit(0)),
        lambda t: lower_ascii(_attribute(t, "http-equiv")) == "refresh",
    )
    targets = F.concat(
        F.transform(links, lambda t: _attribute(t, "href")),
        F.transform(
            metas,
            lambda t: F.regexp_replace(
                F.regexp_extract(_attribute(t, "content"), r"(?is)\burl\s*=\s*(.*)$", 1), r"""^["']|["']$""", ""
            ),
        ),
    )
    # Most pages have neither tag, and the cheap test spares them the rest.
    tagged = pages.where((F.instr("url", "://") > 0) & F.col("html").rlike(r"(?i)canonical|http-equiv"))
    edges = tagged.select(F.col("url"), F.explode(targets).alias("link"))
    return edges.select(without_fragment("url").alias("a"), without_fragment(_absolute(F.col("link"), F.col("url"))).alias("b"))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """Verdict of every page: (page_id, host, path, rule, verdict, alias_of).

    ``pages`` is (page_id, url, html); ``redirects`` adds edges (a, b) between
    URLs, such as a crawler's log. ``rules`` is a list or a table (host, path,
    verdict) of any length. A rule that fits a page decides it. A page
    without rule is blocked if a rule blocks any alias, be it crawled or only
    linked to, and otherwise allowed; ``alias_of`` is the least URL of its
    group. A null URL, or one without ``://``, has an empty host and path and
    no alias; null html has no links. Repeated rows are judged alike.
    """
    edges = link_edges(pages)
    if redirects is not None:
        known = redirects.where((F.instr("a", "://") > 0) & (F.instr("b", "://") > 0))
        edges = edges.unionByName(known.select(without_fragment("a").alias("a"), without_fragment("b").alias("b")))
    groups = components(edges)
    places = groups.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))})
    judged = with_hits(places, rules)
    blocked = judged.where(F.col("hit.verdict") == "block").select("root").distinct().withColumn("blocked", F.lit(True))
    groups = groups.join(blocked, "root", "left")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # A page that has no alias gets a key of its own, so that such pages don't meet in one task.
    alone = F.concat(F.lit(" "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("host"))
    node = F.when(F.instr("url", "://") > 0, without_fragment("url")).otherwise(alone)
    rows = with_hits(rows, rules).withColumn("node", F.coalesce(node, alone)).join(groups, "node", "left")
    by_alias = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", by_alias).alias("verdict"),
        F.col("root").alias("alias_of"),
    )
