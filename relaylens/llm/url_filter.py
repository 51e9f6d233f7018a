"""URL allow and block lists as a trie over reversed host labels, then path segments.

A rule is an action and a host with a path, written ``host/path``. It fits its
host and all subdomains whose url path starts with the rule's path. The walk
goes down the host labels from the right and, at every label on the way, down
the path segments; the longest fitting rule (characters of host and path) wins;
of equally long ones ``block`` goes before ``allow``, then the longer host. Where
both actions are given for one place it is blocked. Urls that no rule fits get
the default verdict. A rule's unfinished last segments are found by their lengths, so the
time of a url does not grow with the rules of a host.

The trie is sent to every task; the rules are a literal list that the caller
holds, checked against ``MAX_RULES``.

Defined cases: a null url or one without ``://`` has an empty host and path;
no rule fits an empty host or an empty path unless the rule's path is empty.
Repeated rows stay, other columns are kept; a column named as the output raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

#: Bound on the rules that are sent to every task.
MAX_RULES = 2_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path) of a url; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    host = rest[:end].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return host, tail[:stop]


class UrlTrie:
    """Nested dicts: host labels from the right; under ``PATHS`` of a label the
    path segments; under ``ENDS`` of a segment node the unfinished last segments, by their length."""

    PATHS, ENDS = 0, 1                                    # keys that no label or segment (text) equals

    def __init__(self, rules: Sequence[tuple[str, str]] = (), root: dict | None = None):
        self.root: dict = {} if root is None else root
        for action, rule in rules:
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(self.PATHS, {})
            *whole, last = (slash + path).split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(self.ENDS, {}).setdefault(len(last), {})
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (rule, action)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits."""
        best, rank, node, segments = None, None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            at = node.get(self.PATHS)
            for segment in segments:
                if at is None:
                    break
                for length, ends in at.get(self.ENDS, {}).items():
                    found = ends.get(segment[:length]) if length <= len(segment) else None
                    if found:
                        own = (len(found[0]), found[1] == "block")
                        if best is None or own >= rank:            # later ones have the longer host
                            best, rank = found, own
                at = at.get(segment)
        return best


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url",
               out: str = "judged", default: str = "allow") -> DataFrame:
    """``pages`` with a struct column ``out``: host, path, rule (null if none
    fits) and verdict."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules are more than the {MAX_RULES} that every task may receive")
    if out.lower() in {c.lower() for c in pages.columns}:
        raise ValueError(f"the input has a column {out!r} already")
    bad = [a for a, _ in rules if a not in ("allow", "block")]
    if bad:
        raise ValueError(f"unknown action {bad[0]!r}")
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules).root)     # plain dicts

    def make():
        tree = UrlTrie(root=trie.value)

        def judge(urls):
            parts = [split_url(u) for u in urls]
            found = [tree.match(*p) for p in parts]
            return {"host": [p[0] for p in parts], "path": [p[1] for p in parts],
                    "rule": [f and f[0] for f in found], "verdict": [f[1] if f else default for f in found]}
        return judge

    return pages.withColumn(out, per_text(F.col(url_col), make,
                                          "host string, path string, rule string, verdict string"))
