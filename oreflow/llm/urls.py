"""URL filters: a broadcast trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER, UPPER

MAX_RULES = 1_000_000
_LOWER = str.maketrans(UPPER, LOWER)
_ENDS = str.maketrans({"?": "/", "#": "/"})


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path. Both are empty for NULL and for a text without ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    cut = len(rest.translate(_ENDS).partition("/")[0])
    path = rest[cut:].partition("?")[0].partition("#")[0]
    return rest[:cut].translate(_LOWER), path


def build_trie(rules: Sequence[tuple[str, str]]) -> dict:
    """A trie from rules ``(verdict, "host/path")``.

    A host node maps the next label to its node; under ``""`` it keeps the paths of the rules that
    end there, as a trie of whole segments. What follows a rule's last slash is kept beside the
    node as a tail, since a rule path is a prefix and may end inside a segment. A rule given twice
    keeps ``block``.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the trie is broadcast, so at most {MAX_RULES} are taken")
    root: dict = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        if verdict not in ("allow", "block") or not host or not slash:
            raise ValueError(f"not a rule: {verdict} {rule}")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.setdefault(label + ".", {})
        node = node.setdefault("", {"next": {}, "tails": {}})
        *whole, tail = path.split("/")
        for segment in whole:
            node = node["next"].setdefault(segment, {"next": {}, "tails": {}})
        if node["tails"].get(tail, ("", ""))[1] != "block":
            node["tails"][tail] = (rule, verdict)
    return root


def _best_path(node: dict, path: str) -> tuple[str, str] | None:
    """The longest rule path that ``path`` starts with."""
    if not path.startswith("/"):
        return None
    best, at = None, 1
    while True:
        tails = node["tails"]
        hit = max((t for t in tails if path.startswith(t, at)), key=len, default=None)
        best = best if hit is None else tails[hit]
        segment, slash, _ = path[at:].partition("/")
        if not slash or segment not in node["next"]:
            return best
        node, at = node["next"][segment], at + len(segment) + 1


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The rule and verdict with the longest host, and among those the longest path."""
    node, paths = trie, []
    for label in reversed(host.split(".")):
        node = node.get(label + ".")
        if node is None:
            break
        if "" in node:
            paths.append(node[""])
    return next((found for p in reversed(paths) if (found := _best_path(p, path))), None)


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host, path, rule, verdict`` to every row; no shuffle.

    A rule fits its host and all subdomains of it when the path starts with the rule's path; the
    longest host wins, then the longest path. Without a rule the verdict is ``default``. NULL urls
    have an empty host and path and no rule. Other columns stay as they are; columns that already
    have one of the four names are replaced. Repeated rows are judged each; an empty table gives
    an empty result.
    """
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.arrow_udf("struct<host string, path string, rule string, verdict string>")
    def judge(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in urls:
            rows = []
            for host, path in map(split_url, batch.to_pylist()):
                rule, verdict = match(trie.value, host, path) or (None, default)
                rows.append((host, path, rule, verdict))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            names = ("host", "path", "rule", "verdict")
            yield pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], list(names))

    judged = df.drop("host", "path", "rule", "verdict").withColumn("_judged", judge(F.col(url)))
    return judged.select(*[c for c in judged.columns if c != "_judged"], "_judged.*")
