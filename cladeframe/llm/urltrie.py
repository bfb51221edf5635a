"""URL filters by a trie over reversed host labels and path segments.

The trie is made on the driver and broadcast; its size is checked first (``MOST_RULES``). A rule's last path segment may be
cut short: the url's path only has to start with the rule's. Deeper hosts win over shallower ones, then longer paths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A trie of so many rules takes under 1 GB. More of them need a join by host instead.
MOST_RULES = 1_000_000

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str  # starts with /, or is empty

    @property
    def name(self) -> str:
        return f"{self.host}{self.path or '/'}"


@dataclass
class _Node:
    labels: dict[str, _Node] = field(default_factory=dict)
    paths: _Path | None = None


@dataclass
class _Path:
    segments: dict[str, _Path] = field(default_factory=dict)
    #: last pieces of rules that end inside a segment here, by length, longest first
    ends: dict[int, dict[str, UrlRule]] = field(default_factory=dict)


class UrlTrie:
    def __init__(self, rules):
        rules = list(rules)
        if len(rules) > MOST_RULES:
            raise ValueError(f"{len(rules)} rules; {MOST_RULES} fit a broadcast trie")
        self.root = _Node()
        for r in rules:
            node = self.root
            for label in reversed(r.host.split(".")):
                node = node.labels.setdefault(label, _Node())
            node.paths = node.paths or _Path()
            at = node.paths
            *whole, last = r.path.split("/") if r.path else [""]
            for segment in whole:
                at = at.segments.setdefault(segment, _Path())
            held = at.ends.setdefault(len(last), {})
            # of two rules for the same place, block wins
            if last not in held or r.verdict == "block":
                held[last] = r
        self._sort(self.root)

    def _sort(self, top: _Node) -> None:
        nodes, paths = [top], []
        while nodes:
            n = nodes.pop()
            nodes += n.labels.values()
            paths += [n.paths] if n.paths else []
        while paths:
            p = paths.pop()
            p.ends = dict(sorted(p.ends.items(), reverse=True))
            paths += p.segments.values()

    def find(self, host: str, path: str) -> UrlRule | None:
        """The longest rule that fits: by host labels, then by path."""
        chain, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths:
                chain.append(node.paths)
        parts = path.split("/")
        for top in reversed(chain):
            at, found = top, None
            for segment in parts:
                for size, held in at.ends.items():
                    if size <= len(segment) and (hit := held.get(segment[:size])):
                        found = hit
                        break
                at = at.segments.get(segment)
                if at is None:
                    break
            if found:
                return found
        return None


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty if there is no ``://``."""
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_UPPER), path[:stop]


def judge_urls(pages: DataFrame, rules, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict appended (columns of these names are replaced). ``default`` is the verdict where no rule fits.

    Null url or one without ``://``: empty host and path. Repeated rows repeat. Empty table: no rows.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    added = ["host", "path", "rule", "verdict"]
    rest = pages.drop(*[c for c in added if c != url_col])
    at = rest.columns.index(url_col)
    schema = T.StructType([*rest.schema.fields, *(T.StructField(c, T.StringType()) for c in added)])

    def run(batches):
        find = trie.value.find
        for b in batches:
            rows = []
            for url in b.column(at).to_pylist():
                host, path = split_url(url)
                rule = find(host, path) if host else None
                rows.append((host, path, rule.name if rule else None, rule.verdict if rule else default))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.string()) for c in cols)], names=[*b.schema.names, *added])

    return rest.mapInArrow(run, schema)


# The rules of the query.
RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)


def url_report(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", F.col("verdict"))
