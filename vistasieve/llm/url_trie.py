"""URL filter: a trie over reversed host labels, then path segments; the longest matching rule decides.

A rule is ``(verdict, host, path)``. It fits a url whose host is the rule's host or a subdomain of it and whose
path starts with the rule's path. Of the fitting rules the one with the longest ``host + path`` wins (ties: the longer
host). Urls that no rule fits get ``default``.

Defined cases: a null url or one without ``://`` has an empty host and path, so only ``default`` applies; an empty table
gives an empty result; a url of any length is read once; repeated rows are judged one by one; columns other than the id and the url are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import with_fields

Rule = tuple[str, str, str]
MAX_RULE_BYTES = 64 << 20  # bound of what is broadcast: the rules' own text
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty when it is null or has no ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    end = m.start() if (m := _HOST_END.search(rest)) else len(rest)
    return rest[:end].translate(_LOWER), _PATH_END.split(rest[end:], maxsplit=1)[0]


def segments(path: str) -> list[str]:
    """Path segments, each with the slash that ends it: ``/en/a`` gives ``/``, ``en/``, ``a``."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


class Node:
    __slots__ = ("down", "paths", "rule", "tails")

    def __init__(self):
        self.down: dict[str, Node] = {}     # next host label or path segment
        self.paths: Node | None = None      # at a host node: its rules' path segments
        self.rule: tuple | None = None      # at a path node: the rule that ends here
        self.tails: dict[str, tuple] = {}   # at a path node: rules that end inside the next segment


def build_trie(rules: Sequence[Rule]) -> Node:
    root = Node()
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict must be allow or block, not {verdict!r}")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.down.setdefault(label, Node())
        node.paths = node.paths or Node()
        node = node.paths
        *whole, last = segments(path) or [""]
        for seg in whole:
            node = node.down.setdefault(seg, Node())
        entry = (len(host) + len(path), len(host), verdict, host + path)
        if last.endswith("/") or not last:
            node = node.down.setdefault(last, Node()) if last else node
            old, node.rule = node.rule, entry
        else:
            old, node.tails[last] = node.tails.get(last), entry
        if old and old[2] != verdict:
            raise ValueError(f"{host + path} is both allowed and blocked")
    return root


def longest_match(root: Node, host: str, path: str) -> tuple | None:
    best, node, segs = None, root, segments(path)
    for label in reversed(host.split(".")):
        node = node.down.get(label)
        if node is None:
            break
        at, i = node.paths, 0
        while at is not None:
            found = [at.rule, *(r for tail, r in at.tails.items() if i < len(segs) and segs[i].startswith(tail))]
            best = max((x for x in (best, *found) if x), default=None)
            at, i = (at.down.get(segs[i]), i + 1) if i < len(segs) else (None, i)
    return best


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id",
                 url_col: str = "url") -> DataFrame:
    """One row per page: the id, ``host``, ``path``, the deciding ``rule`` (null if none) and ``verdict``."""
    size = sum(len(h) + len(p) for _, h, p in rules)
    if size > MAX_RULE_BYTES:
        raise ValueError(f"the rules hold {size} characters; the broadcast bound is {MAX_RULE_BYTES}")
    src = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judge(batches):
        root = trie.value
        for batch in batches:
            split = [split_url(u) for u in batch.column(1).to_pylist()]
            hits = [longest_match(root, *x) for x in split]
            cols = ([h for h, _ in split], [p for _, p in split], [x and x[3] for x in hits],
                    [x[2] if x else default for x in hits])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in cols)],
                                             names=[id_col, "host", "path", "rule", "verdict"])

    return src.mapInArrow(judge, with_fields(src, id_col, "host string, path string, rule string, verdict string"))
