"""Records of XML files read block by block, whatever their elements' names.

The text source deals byte ranges of the files (blocks) over tasks, cut before
``</``. A task goes through the markup of its blocks in order and keeps the open
elements: their names, the text before their first child, and the texts of the
wanted children. An element whose start and end are in one block is judged
there. What a block leaves open, and what it closes of blocks before, is its
edge: one small row a block. The edges of a file are then folded in order,
which closes the elements that reach over blocks and proves the file complete.
So every file is read once, by as many tasks as it has blocks, for all element
names together, and records may be nested at any depth.

A block may begin inside a comment or a CDATA section, where ``</`` may stand
too. The block before then ends in markup it could not finish; that rest is put
before the block, which is read again (rarely: else the rest is empty).

A file must be UTF-8 and well formed, as far as reading needs it: tags nested,
one root, known character references, no text outside the root. Anything else,
a DOCTYPE with declarations of its own included, raises ``ValueError`` in the
task, and so fails the read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# workers need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A rest that long is looked at again only when it has doubled.
LONG_REST = 1 << 20

_NAME = rb"""[^\s<>/!?"'&=]+"""
_TOKEN = re.compile(
    rb"([^<]*)<(?:(" + _NAME + rb")>([^<]*)</\2\s*>"
    rb"|(/?)(" + _NAME + rb")(?:\s+" + _NAME + rb"""\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*(/?)>"""
    rb"|!\[CDATA\[(.*?)\]\]>|(!--.*?-->|\?.*?\?>|!DOCTYPE[^\[>]*>))", re.S)
# Elements without attributes and children, one after the other: most of a record.
_LEAVES = re.compile(rb"([^<]*)((?:<(" + _NAME + rb")>[^<]*</\3\s*>[^<]*)+)")
_LEAF = re.compile(rb"<(" + _NAME + rb")>([^<]*)</")
_SPECIAL = re.compile(rb"<(?:!--|!\[CDATA\[|\?|!DOCTYPE[^\[]*$|!(?:-|\[|\[C|\[CD|\[CDA|\[CDAT|\[CDATA)?$)")
_REFERENCE = re.compile(r"&(?:#(\d+)|#x([0-9a-fA-F]+)|(\w+));|&")
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

BLOCK = ("file long, block long, record array<string>, "
         "edge array<struct<name: string, text: string, done: boolean, kids: map<string,string>, "
         "children: int, stray: boolean, end: string>>, rest binary")


def _reference(m: re.Match) -> str:
    if m[1] or m[2]:
        return chr(int(m[1]) if m[1] else int(m[2], 16))
    if m[3] not in _ENTITIES:
        raise ValueError(f"unknown reference {m[0]!r}")
    return _ENTITIES[m[3]]


def decoded(raw: bytes) -> str:
    text = raw.decode("utf-8")
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    return _REFERENCE.sub(_reference, text) if "&" in text else text


def local(name: bytes) -> str:
    return name.rpartition(b":")[2].decode("utf-8")


@dataclass(slots=True)
class Element:
    """An open element. ``name`` is None for one that an earlier block opened;
    ``text`` is what stands before the first child (``done``); ``stray``: other
    text after it (noted where the element may be the file itself)."""
    name: str | None
    text: str = ""
    done: bool = False
    kids: dict[str, str] = field(default_factory=dict)
    children: int = 0
    stray: bool = False

    def child(self, name: str, text: str, wanted: frozenset[str]) -> None:
        self.done = True
        self.children += 1
        if name in wanted:
            self.kids.setdefault(name, text)


Rule = Callable[[str, dict[str, str]], bool]


class Block:
    """The elements of one block, judged by ``rule(name, children)``."""

    def __init__(self, wanted: frozenset[str], rule: Rule, rest: bytes = b""):
        self.wanted, self.rule, self.rest = wanted, rule, rest
        self.names: dict[bytes, tuple[str, bool]] = {}
        self.ends: list[tuple[Element, str]] = []    # elements of earlier blocks that end here
        self.open = [Element(None)]

    def named(self, name: bytes) -> tuple[str, bool]:
        """The local name, and whether such an element without children is a record."""
        tag = local(name)
        self.names[name] = out = tag, self.rule(tag, {})
        return out

    def feed(self, data: bytes, last: bool = False) -> list[dict[str, str]]:
        """The children of the records that end in ``data``."""
        known = len(self.rest)
        data = self.rest + data
        if not last and LONG_REST < known and len(data) < 2 * known:
            self.rest = data
            return []
        out, top, at, wanted, match = [], self.open[-1], 0, self.wanted, _TOKEN.match
        names = self.names
        while True:
            if top.name is not None and (m := _LEAVES.match(data, at)):
                at = m.end()
                if m[1] and not top.done:
                    top.text += decoded(m[1])
                top.done, kids, leaves = True, top.kids, _LEAF.findall(m[2])
                top.children += len(leaves)
                for leaf, inner in leaves:
                    tag, bare = names.get(leaf) or self.named(leaf)
                    if tag in wanted and tag not in kids:
                        kids[tag] = decoded(inner)
                    if bare:
                        out.append({})
            if not (m := match(data, at)):
                break
            at = m.end()
            text, leaf, inner, slash, name, empty, cdata, other = m.groups()
            if text:
                if not top.done:
                    top.text += decoded(text)
                elif top.name is None and not top.stray:
                    top.stray = not text.isspace()
            if leaf is not None:
                tag, bare = names.get(leaf) or self.named(leaf)
                top.child(tag, decoded(inner) if tag in wanted else "", wanted)
                if bare:
                    out.append({})
            elif name is not None:
                tag, bare = names.get(name) or self.named(name)
                if empty:
                    top.child(tag, "", wanted)
                    if bare:
                        out.append({})
                elif not slash:
                    top.done = True
                    top = Element(tag)
                    self.open.append(top)
                elif len(self.open) == 1:
                    self.ends.append((top, tag))
                    # the parent is open since before as well; it gets the child when the edges are folded
                    top = self.open[0] = Element(None, done=True)
                else:
                    if top.name != tag:
                        raise ValueError(f"<{top.name}> is ended by </{tag}>")
                    self.open.pop()
                    if self.rule(tag, top.kids):
                        out.append(top.kids)
                    self.open[-1].child(tag, top.text, wanted)
                    top = self.open[-1]
            elif cdata is not None:
                if not top.done:
                    top.text += cdata.decode("utf-8")
            elif other.startswith(b"?xml") and (enc := re.search(rb"""encoding\s*=\s*["']([^"']+)""", other)):
                if enc[1].lower() not in (b"utf-8", b"utf8", b"us-ascii", b"ascii"):
                    raise ValueError(f"encoding {enc[1].decode()} is not read")
        self.rest = data[at:]
        start = self.rest.find(b"<")
        if last and start < 0:               # text; the next block begins with a tag
            if not top.done:
                top.text += decoded(self.rest)
            top.stray |= top.done and bool(self.rest.strip())
            self.rest = b""
        if start >= 0 and self.rest.find(b"<", start + 1) >= 0 and not _SPECIAL.match(self.rest, start):
            raise ValueError(f"malformed markup: {self.rest[start:start + 60]!r}")
        return out

    def edge(self) -> list[dict]:
        rows = [(e, end) for e, end in self.ends] + [(e, None) for e in self.open]
        return [{"name": e.name, "text": e.text, "done": e.done, "kids": list(e.kids.items()),
                 "children": e.children, "stray": e.stray, "end": end} for e, end in rows]


def fold(pdf: pd.DataFrame, wanted: frozenset[str], rule: Rule) -> list[dict[str, str]]:
    """Children of the records of one file that reach over blocks; raises if
    the file isn't one closed root."""
    out: list[dict[str, str]] = []
    stack = [Element("")]                      # the file
    pdf = pdf.sort_values("block")
    for k, (edge, rest) in enumerate(zip(pdf["edge"], pdf["rest"])):
        if k == len(pdf) - 1 and rest:
            raise ValueError(f"the file ends in {bytes(rest)[:60]!r}")
        for part in edge:
            kids = dict(part["kids"])
            if part["name"] is None:
                top = stack[-1]
                top.text += "" if top.done else part["text"]
                top.done |= bool(part["done"])
                top.stray |= bool(part["stray"])
                top.children += part["children"]
                for name, text in kids.items():
                    top.kids.setdefault(name, text)
                if part["end"] is None:
                    continue
                if len(stack) == 1 or top.name != part["end"]:
                    raise ValueError(f"<{top.name}> is ended by </{part['end']}>")
                stack.pop()
                if rule(top.name, top.kids):
                    out.append(top.kids)
                stack[-1].child(top.name, top.text, wanted)
            else:
                stack[-1].done = True
                stack.append(Element(part["name"], part["text"], bool(part["done"]), kids))
    if len(stack) > 1:
        raise ValueError(f"<{stack[-1].name}> does not end")
    if stack[0].children != 1 or stack[0].stray or stack[0].text.strip("\ufeff \t\r\n"):
        raise ValueError("not one root element")
    return out


# --------------------------------------------------------------------------
# Spark jobs

def _blocks(spark: SparkSession, path: str, name_glob: str) -> DataFrame:
    """The files' bytes in pieces that begin with ``</`` (a file's first one
    gets it as well), with file and block."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob).option("lineSep", "</").text(path)
            .select(F.xxhash64(F.input_file_name()).alias("file"), F.input_file_block_start().alias("block"),
                    F.concat(F.lit("</"), "value").cast("binary").alias("data")))


def _parsed(blocks: DataFrame, tags: list[str], rule: Rule, rests: dict[tuple[int, int], bytes]) -> DataFrame:
    wanted = frozenset(tags)
    kind = pa.struct([("name", pa.string()), ("text", pa.string()), ("done", pa.bool_()),
                      ("kids", pa.map_(pa.string(), pa.string())), ("children", pa.int32()), ("stray", pa.bool_()), ("end", pa.string())])
    names = ["file", "block", "record", "edge", "rest"]

    def rows(at, records=(), edge=None, rest=None) -> pa.RecordBatch:
        n = len(records) + (edge is not None)
        last = [None] * len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]] * n, pa.int64()), pa.array([at[1]] * n, pa.int64()),
             pa.array([[r.get(t) for t in tags] for r in records] + [None] * (edge is not None), pa.list_(pa.string())),
             pa.array(last + [edge] if edge is not None else last, pa.list_(kind)),
             pa.array(last + [rest] if edge is not None else last, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for batch in batches:
            file, start = batch.column("file").to_numpy(), batch.column("block").to_numpy()
            cuts = [0, *((file[1:] != file[:-1]) | (start[1:] != start[:-1])).nonzero()[0] + 1, len(file)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                at = (int(file[a]), int(start[a]))
                if at != now:
                    if block is not None:
                        yield rows(now, block.feed(b"", last=True), block.edge(), block.rest)
                    now, block, head = at, Block(wanted, rule, rests.get(at, b"")), 2 * (at[1] == 0)
                # the pieces of a column lie one after the other
                part = batch.column("data").slice(a, b - a)
                offsets = memoryview(part.buffers()[1]).cast("i")
                found = block.feed(part.buffers()[2][offsets[part.offset] + head:offsets[part.offset + len(part)]].to_pybytes())
                head = 0
                if found:
                    yield rows(now, found)
        if block is not None:
            yield rows(now, block.feed(b"", last=True), block.edge(), block.rest)

    return blocks.mapInArrow(run, BLOCK)


def xml_records(spark: SparkSession, path: str, name_glob: str, tags: list[str], rule: Rule, scratch: str) -> DataFrame:
    """One row per element of the files for which ``rule(local name, wanted
    children)`` holds: a column per tag with the text before the first child
    of the first such child, null where there is none. What is parsed is
    written below ``scratch``, a folder that all executors share."""
    blocks, tags, wanted = _blocks(spark, path, name_glob), list(tags), frozenset(tags)
    at = F.struct("file", "block")
    rests: dict[tuple[int, int], bytes] = {}
    parsed, turn, again = None, 0, blocks
    while True:
        _parsed(again, tags, rule, rests).write.parquet(f"{scratch}/blocks-{turn}")
        fresh = spark.read.parquet(f"{scratch}/blocks-{turn}")
        parsed = fresh if parsed is None else parsed.where(~at.isin(_literals(redo))).unionByName(fresh)
        # the rest of the block before, where it isn't what the block was read with: no rows but for
        # blocks that begin inside a comment, CDATA or text; of one row a block
        order = Window.partitionBy("file").orderBy("block")
        before = parsed.where("edge is not null").select("file", "block", F.lag("rest").over(order).alias("rest"))
        doubt = F.length("rest") > 0
        if rests:
            doubt = doubt | at.isin(_literals(rests))
        read = {(r["file"], r["block"]): bytes(r["rest"] or b"") for r in before.where(doubt).collect()}
        redo = [k for k, rest in read.items() if rests.get(k, b"") != rest]
        if not redo:
            break
        rests |= read
        again, turn = blocks.where(at.isin(_literals(redo))), turn + 1

    def closed(pdf: pd.DataFrame) -> pd.DataFrame:
        found = fold(pdf, wanted, rule)
        return pd.DataFrame({"record": pd.Series([[r.get(t) for t in tags] for r in found], dtype=object)})

    over = (parsed.where("edge is not null").select("file", "block", "edge", "rest")
            .groupBy("file").applyInPandas(closed, "record array<string>"))
    records = parsed.where("record is not null").select("record").unionByName(over)
    return records.select(*[F.col("record")[i].alias(t) for i, t in enumerate(tags)])


def _literals(keys):
    return [F.struct(F.lit(f).cast("long").alias("file"), F.lit(b).cast("long").alias("block")) for f, b in keys]
