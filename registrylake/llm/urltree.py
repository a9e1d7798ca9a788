"""URL verdicts from rules and, where no rule fits, from a tree of path templates.

Pages that a rule fits are the labelled ones. For the others each host has a tree over the segments of its paths, grown level by level
from the counts of equal paths:

* *Generalise.* A segment that looks like a number, a date, a hash or another word with digits becomes the wildcard of its look, with its
  file extension. Of all segments below a node, those on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the node's keep their name;
  the rest are one wildcard.
* *Merge.* Named branches of a node whose next segments look alike, by a chi-square test over the looks or by a small effect, become
  one branch: the one with the most pages first, each into the first that it resembles. A node has at most ``1 / MIN_SHARE`` named
  branches and a fixed number of looks, so this work is bounded per node, however many pages a host has.
* *Reject.* A template is a path of the tree down to its end. Its purity is the blocked share of its labelled pages, with
  ``SMOOTHING`` imaginary ones, half of them blocked, added. Pages of a template with a purity of ``REJECT`` or more are blocked.

Segments behind ``LEVELS`` are taken together as one: its name is the rest of the path.

Defined results: a null url, or one without ``://``, has an empty host and path, which no rule fits and no evidence blocks; equal urls,
page ids that repeat and null ids are judged row by row; an empty table gives no rows; other columns, and columns of the names used
here, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrylake.session import materialise

LEVELS = 6
MIN_PAGES = 5
MIN_SHARE = 1 / 64
SIGNIFICANT = 2.326  # the normal quantile of 99 %
SMALL_EFFECT = 0.1
SMOOTHING = 4.0
REJECT = 0.8
END = "$"
ANY = "*"

# looks of a segment without its extension, the first that fits; everything else is a name
LOOKS = (
    ("*empty", r"^$"),
    ("*num", r"^[0-9]+$"),
    ("*date", r"^[0-9]{4}[-_.][0-9]{1,2}([-_.][0-9]{1,2})?$"),
    ("*hash", r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"),
    ("*mixed", r"[0-9]"),
)
EXTENSION = r"^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,4})?$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), upper, upper.lower())
    return host, F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule ``host/path`` that fits the host or one above it and begins the path; null if none does."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if found is None else found


def _look(segment: Column, name: Column) -> Column:
    stem, extension = F.regexp_extract(segment, EXTENSION, 1), F.lower(F.regexp_extract(segment, EXTENSION, 2))
    found = F
    for look, pattern in LOOKS:
        found = found.when(stem.rlike(pattern), F.concat(F.lit(look), extension))
    return found.otherwise(name)


def _tokens(path: Column) -> Column:
    """A path as tokens: the look or the name (after ``=``) of each segment, then the end."""
    segments = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substring(path, 2)"), "/", -1))
    looked = F.transform(segments, lambda s: _look(s, F.concat(F.lit("="), s)))
    rest = F.concat(F.slice(looked, 1, LEVELS), F.array(F.concat(F.lit("="), F.array_join(F.slice(looked, LEVELS + 1, F.size(looked)), "/"))))
    return F.concat(F.when(F.size(looked) > LEVELS, rest).otherwise(looked), F.array(F.lit(END)))


def _kind(token: Column) -> Column:
    """What a branch is compared by: one of a fixed set of looks, whatever names and extensions there are."""
    return F.when(token.startswith("="), "name").otherwise(F.regexp_extract(token, r"^[*$][a-z]*", 0))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two counts over the same looks may come from one distribution, or differ by a small effect only."""
    used = (a + b) > 0
    a, b = a[used], b[used]
    free = len(a) - 1
    if not free:
        return True
    n_a, n_b = a.sum(), b.sum()
    chi = ((np.sqrt(n_b / n_a) * a - np.sqrt(n_a / n_b) * b) ** 2 / (a + b)).sum()
    limit = free * (1 - 2 / (9 * free) + SIGNIFICANT * np.sqrt(2 / (9 * free))) ** 3
    return bool(chi <= limit or np.sqrt(chi / (n_a + n_b)) <= SMALL_EFFECT)


def merged_names(branches: dict[str, dict[str, int]]) -> dict[str, str]:
    """Named branches with the counts of the looks that follow, each with the name of its merged branch."""
    looks = sorted({k for counts in branches.values() for k in counts})
    groups: list[tuple[np.ndarray, list[str]]] = []
    for name in sorted(branches, key=lambda x: (-sum(branches[x].values()), x)):
        own = np.array([branches[name].get(k, 0) for k in looks], float)
        for total, names in groups:
            if alike(total, own):
                total += own
                names.append(name)
                break
        else:
            groups.append((own, [name]))
    return {name: names[0] if len(names) == 1 else f"~{min(names)[1:]}+{len(names) - 1}" for _, names in groups for name in names}


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, tokens, branches = [], [], []
        for i, found in enumerate(batch.column("found").to_pylist()):
            counts: dict[str, dict[str, int]] = {}
            for x in found:
                counts.setdefault(x["token"], {})[x["kind"]] = x["n"]
            named = merged_names({t: c for t, c in counts.items() if t.startswith("=")})
            for token in counts:
                at.append(i)
                tokens.append(token)
                branches.append(named.get(token, token))
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("host").take(rows), batch.column("node").take(rows), pa.array(tokens, pa.string()), pa.array(branches, pa.string())],
            ["host", "node", "token", "branch"],
        )


def _grown(paths: DataFrame, level: int) -> DataFrame:
    """Every path with its node one level further down."""
    here = paths.where(F.size("tokens") > level).withColumns(
        {"token": F.element_at("tokens", level + 1), "kind": _kind(F.coalesce(F.try_element_at("tokens", F.lit(level + 2)), F.lit("")))}
    )
    counts = materialise(here.groupBy("host", "node", "token", "kind").agg(F.sum("n").alias("n")), "url-branches")
    pages = counts.groupBy("host", "node", "token").agg(F.sum("n").alias("n"))
    total = pages.groupBy("host", "node").agg(F.sum("n").alias("total"))
    # at most 1 / MIN_SHARE tokens of a node, so the lists below are bounded
    kept = pages.join(total, ["host", "node"]).where((F.col("n") >= MIN_PAGES) & (F.col("n") >= MIN_SHARE * F.col("total")))
    found = counts.join(kept.select("host", "node", "token"), ["host", "node", "token"])
    lists = found.groupBy("host", "node").agg(F.collect_list(F.struct("token", "kind", "n")).alias("found"))
    branches = lists.mapInArrow(_merge, "host string, node string, token string, branch string")
    down = here.drop("kind").join(branches, ["host", "node", "token"], "left")
    down = down.withColumn("node", F.concat("node", F.lit("/"), F.coalesce("branch", F.lit(ANY)))).drop("token", "branch")
    return down.unionByName(paths.where(F.size("tokens") <= level))


def templates(labelled: DataFrame) -> DataFrame:
    """(host, tokens, template, n_blocked, n_allowed, purity) from (host, tokens, verdict): the template of every different path."""
    paths = labelled.groupBy("host", "tokens").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("verdict") == "block").alias("n_blocked"),
        F.count_if(F.col("verdict") == "allow").alias("n_allowed"),
    )
    paths = materialise(paths.withColumn("node", F.lit("")), "url-paths")
    levels = paths.agg(F.max(F.size("tokens"))).first()[0] or 0
    for level in range(levels):  # LEVELS + 2 at most
        paths = materialise(_grown(paths, level), "url-paths")
    stats = paths.groupBy("host", "node").agg(F.sum("n_blocked").alias("n_blocked"), F.sum("n_allowed").alias("n_allowed"))
    purity = (F.col("n_blocked") + SMOOTHING / 2) / (F.col("n_blocked") + F.col("n_allowed") + SMOOTHING)
    found = paths.select("host", "tokens", "node").join(stats.withColumn("purity", purity), ["host", "node"])
    return found.select("host", "tokens", F.col("node").alias("template"), "n_blocked", "n_allowed", "purity")


def judge(pages: DataFrame, allow: Sequence[str], block: Sequence[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page; the last two are null where a rule decides."""
    rows = pages.select(F.col(id_col).alias("page_id"), *[c.alias(n) for c, n in zip(host_and_path(F.col(url_col)), ("host", "path"), strict=True)])
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), [*allow, *block]))
    ruled = F.when(F.col("rule").isin(*block), "block").when(F.col("rule").isNotNull(), "allow")
    rows = rows.withColumns({"verdict": ruled, "tokens": _tokens(F.col("path"))})
    known = templates(rows.select("host", "tokens", "verdict")).select("host", "tokens", "template", "purity")
    # an inner join of all the others, as every path has a template: Spark splits its hot keys
    others = rows.where("rule is null").join(known, ["host", "tokens"])
    others = others.withColumn("verdict", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    decided = rows.where("rule is not null").withColumns({"template": F.lit(None).cast("string"), "purity": F.lit(None).cast("double")})
    names = ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    return decided.select(*names).unionByName(others.select(*names))
