"""URL rules in a trie over reversed host labels and path segments.

The longest fitting rule decides, whether it allows or blocks. The trie goes to every task
once; its size is that of the rule list, which is checked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters of all rules together that may be sent to every task.
MAX_RULE_CHARS = 32_000_000

ALLOW, BLOCK = "allow", "block"
RESULT = "host string, path string, rule string, verdict string"

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_END = re.compile("[/?#]")
_PATH_END = re.compile("[?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path: the host in lower case (A-Z), both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = _HOST_END.search(rest)
    if end is None:
        return rest.translate(_UPPER), ""
    path = rest[end.start() :]
    path_end = _PATH_END.search(path)
    return rest[: end.start()].translate(_UPPER), path[: path_end.start()] if path_end else path


@dataclass
class _Node:
    labels: dict[str, _Node] = field(default_factory=dict)  # the next host label to the left
    segments: dict[str, _Node] = field(default_factory=dict)  # the next whole path segment
    starts: dict[str, tuple[str, str]] = field(default_factory=dict)  # how the next segment starts
    rule: tuple[str, str] | None = None


class RuleTrie:
    """Rules (verdict, ``host/path``); a rule fits its host and all subdomains, if the path of
    the url starts with the rule's.

    More host labels come before a longer path. Of equal rules with both verdicts, block holds.
    """

    def __init__(self, rules: list[tuple[str, str]]) -> None:
        if sum(len(rule) for _, rule in rules) > MAX_RULE_CHARS:
            raise ValueError(f"rules of more than {MAX_RULE_CHARS} characters; split the list")
        self.root = _Node()
        for verdict, rule in sorted(rules):  # block after allow
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"verdict of {rule!r}: {verdict!r}")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".")) if host else ():
                node = node.labels.setdefault(label, _Node())
            *whole, last = (slash + path).split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, _Node())
            if last:
                node.starts[last] = (verdict, rule)
            else:
                node.rule = (verdict, rule)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest fitting rule as (verdict, rule)."""
        node, best = self.root, None
        segments = path.split("/")
        found = self._on_path(node, segments)
        best = found or best
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            best = self._on_path(node, segments) or best
        return best

    @staticmethod
    def _on_path(node: _Node, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for i, segment in enumerate(segments):
            if node.rule is not None:
                best = node.rule
            for length in range(1, len(segment) + 1) if node.starts else ():
                best = node.starts.get(segment[:length], best)
            # A whole segment is one with a slash behind it.
            node = node.segments.get(segment) if i + 1 < len(segments) else None
            if node is None:
                return best
        return best


def match_urls(
    df: DataFrame, rules: list[tuple[str, str]], url: str = "url", key: str = "page_id", default: str = ALLOW
) -> DataFrame:
    """host, path, rule and verdict of every url; without a fitting rule the rule is null and
    the verdict ``default``.

    Null urls and urls without ``://`` have an empty host and path, which no rule of a host fits.
    Every row gives one row, repeated ones too; a null key stays null; very long urls are split
    once; an empty table gives an empty table. Only ``key`` and ``url`` are read, so other
    columns may have any names.
    """
    trie = df.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    def judge(batches):
        known = trie.value
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                host, path = split_url(text)
                verdict, rule = known.find(host, path) or (default, None)
                rows.append((host, path, rule, verdict))
            columns = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in columns)],
                names=[key, "host", "path", "rule", "verdict"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, url).mapInArrow(judge, f"`{key}` {kind}, {RESULT}")
