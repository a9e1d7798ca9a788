import random
import re
from collections import Counter, defaultdict

import pytest

from registrylake.llm import urltree
from registrylake.llm.queries import ALLOWED_URLS, BLOCKED_URLS, op11_path_template_verdicts

COLUMNS = ["page_id", "host", "path", "rule", "verdict"]


def _split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    if not m:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def _rule(host, path):
    fits = []
    for rule in [*ALLOWED_URLS, *BLOCKED_URLS]:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append(rule)
    return max(fits, key=len, default=None)


def _tokens(path):
    if not path:
        return ["$"]

    def look(s):
        stem, ext = re.match(r"^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,4})?$", s, re.S).groups()
        for name, pattern in urltree.LOOKS:
            if re.search(pattern, stem):
                return name + (ext or "").lower()
        return "=" + s

    found = [look(s) for s in path[1:].split("/")]
    if len(found) > urltree.LEVELS:
        found = found[: urltree.LEVELS] + ["=" + "/".join(found[urltree.LEVELS :])]
    return [*found, "$"]


def _kind(token):
    return "name" if token.startswith("=") else re.match(r"^([*$][a-z]*)?", token)[0]


def _brute(pages):
    """Verdicts of [(page_id, url)], the tree of each host grown in memory."""
    rows = []
    for page, url in pages:
        host, path = _split(url)
        rule = _rule(host, path)
        rows.append((page, host, path, rule, None if rule is None else "block" if rule in BLOCKED_URLS else "allow"))
    tokens = [_tokens(r[2]) for r in rows]
    node = [""] * len(rows)
    for level in range(max(map(len, tokens), default=0)):
        inside = defaultdict(list)
        for i, t in enumerate(tokens):
            if len(t) > level:
                inside[rows[i][1], node[i]].append(i)
        for members in inside.values():
            n = Counter(tokens[i][level] for i in members)
            kept = {t for t in n if n[t] >= urltree.MIN_PAGES and n[t] >= urltree.MIN_SHARE * len(members)}
            named = defaultdict(Counter)
            for i in members:
                t = tokens[i][level]
                if t in kept and t.startswith("="):
                    named[t][_kind(tokens[i][level + 1])] += 1
            names = urltree.merged_names(named)
            for i in members:
                t = tokens[i][level]
                node[i] += "/" + (names.get(t, t) if t in kept else "*")
    blocked, labelled = Counter(), Counter()
    for r, place in zip(rows, node):
        if r[4]:
            labelled[r[1], place] += 1
            blocked[r[1], place] += r[4] == "block"
    out = []
    for r, place in zip(rows, node):
        purity = (blocked[r[1], place] + urltree.SMOOTHING / 2) / (labelled[r[1], place] + urltree.SMOOTHING)
        out.append((*r[:4], r[4] or ("block" if purity >= urltree.REJECT else "allow")))
    return sorted(out, key=repr)


def _pages(seed, n):
    rng = random.Random(seed)
    urls = []
    hosts = ["a.example.com", "b.example.com", "WWW.c.com", "de.org", "x.net", "example.org", "xorg"]
    for _ in range(n):
        host = rng.choice(hosts[:2] * 4 + hosts)
        langs = ["de", "it"] if host.startswith("a.") else ["de", "fr", "en", "it", "tag"]
        lang = rng.choice(langs)
        middle = {"tag": ["red", "blue", f"slug-{rng.randint(0, 99)}", "word" * rng.randint(1, 9)]}.get(lang, [str(rng.randint(0, 999))])
        path = "/".join([lang, rng.choice(middle)] + rng.choice([[], [""], ["2024-01-05", "a1b2c3d4e5"], list("abcdefgh")]))
        urls.append(f"http://{host}/{path}" + rng.choice(["", ".html", "?q=/de/#x", "#top"]))
    return list(enumerate(urls))


def _table(spark, pages):
    return spark.createDataFrame(pages, "page_id bigint, url string")


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_equal_brute_force(spark, tmp_path, seed):
    pages = _pages(seed, 900)
    _table(spark, pages).selectExpr("*", "'x' AS host", "'y' AS verdict", "1 AS n").write.parquet(f"{tmp_path}/pages.parquet")
    found = _rows(op11_path_template_verdicts(spark, str(tmp_path)))
    assert found == _brute(pages)
    # /it/ of a host whose only labelled branch looks the same and is blocked goes with it, and nothing of other hosts does
    blocked = {r[1] for r in found if r[4] == "block" and r[3] is None}
    assert blocked == {"a.example.com"}


def test_odd_rows(spark):
    pages = [
        (1, None), (1, None), (None, "no url"), (2, ""), (3, "http://"), (4, "http://Example.ORG"), (5, "x://example.org/es/1"),
        (6, "http://example.org/en/1"), (7, "http://example.org/en/21"), (8, "http://notorg/x"), (9, "http://org/"), (10, "http://a.org?x://b.com/de/"),
        (11, "http://ÄB.com/de/\n/x"), (12, "http://h.net/" + "a/" * 20_000), (13, "://k.com/fr/://com/de/"),
    ]
    found = _rows(urltree.judge(_table(spark, pages), ALLOWED_URLS, BLOCKED_URLS))
    assert found == _brute(pages)
    rules = {r[0]: r[3] for r in found}
    assert rules[6] == "example.org/en/1" and rules[7] == rules[9] == "org/" and rules[5] == "example.org/es/"
    assert rules[4] is rules[8] is rules[10] is None
    assert urltree.judge(_table(spark, []), ALLOWED_URLS, BLOCKED_URLS).collect() == []


def test_unlike_branches_stay_apart():
    names = urltree.merged_names({"=a": {"*num": 50, "$": 50}, "=b": {"*num": 24, "$": 26}, "=c": {"name": 40}})
    assert names == {"=a": "~a+1", "=b": "~a+1", "=c": "=c"}
