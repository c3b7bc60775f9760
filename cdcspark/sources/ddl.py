"""Columns of CREATE TABLE texts, read by a scanner that knows quotes, brackets and comments.

A text is cut into tokens (quoted texts and names whole, comments away), and one pass over the tokens keeps
the depth of brackets: commas at depth one part the table's items. So a text in one line, a comment with
``not null`` in it, or a default with a comma are read as what they are. Each text is read once, in the task
that has it; texts are dealt over the tasks first, as a small file of names may make many long ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Names in backticks, texts in quotes (doubled or escaped ones inside), comments, brackets and commas, words.
TOKEN = re.compile(r"""`(?:[^`]|``)*`|'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|--[^\n]*|#[^\n]*|/\*.*?\*/|[(),;=]|[^\s`'"(),;=#]+""", re.DOTALL | re.ASCII)
KEYED = re.compile(r"(constraint( \S+)? )?primary key", re.IGNORECASE | re.ASCII)
#: First words of items that are no columns, words of keys that name none, and words that end a default.
NO_COLUMN = {"PRIMARY", "UNIQUE", "KEY", "INDEX", "CONSTRAINT", "FULLTEXT", "SPATIAL", "FOREIGN", "CHECK", "LIKE", "PERIOD"}
NO_KEY = {"(", ")", ",", "ASC", "DESC", "USING", "BTREE", "HASH"}
AFTER_DEFAULT = {"NOT", "NULL", "ON", "COMMENT", "AUTO_INCREMENT", "PRIMARY", "UNIQUE", "KEY", "GENERATED", "AS", "COLLATE", "CHECK", "REFERENCES", "INVISIBLE", "VISIBLE", "STORED", "VIRTUAL", "COLUMN_FORMAT", "STORAGE"}
NUMBER = re.compile("[0-9]+")
ROW = "ordinal int, column string, type string, nullable boolean, auto boolean, generated boolean, is_pk boolean, default string, comment string"


def tokens(ddl: str) -> list[str]:
    return [t for t in TOKEN.findall(ddl) if not t.startswith(("--", "#", "/*"))]


def unquoted(t: str) -> str:
    """Content of a quoted text or name; other tokens stay."""
    if t[0] == "`":
        return t[1:-1].replace("``", "`")
    return re.sub(r"\\(.)", r"\1", t[1:-1].replace("''", "'")) if t[0] in "'\"" else t


def items(toks: list[str]) -> list[list[str]]:
    """The token lists between commas at depth one, inside the table's brackets; what follows these is left out."""
    depth, item, out = 0, [], []
    for t in toks:
        before, depth = depth, depth + (t == "(") - (t == ")")
        if before < 1:
            continue
        if depth == 0 or (t == "," and before == 1):
            out.append(item)
            item = []
            if depth == 0:
                break
        else:
            item.append(t)
    return [x for x in (*out, item) if x]


def outside(item: list[str]) -> list[tuple[str, int]]:
    """(word, at) of an item's tokens outside its brackets: words upper-case, quoted ones as they are."""
    depth, out = 0, []
    for at, t in enumerate(item):
        if depth == 0 and t != "(":
            out.append((t if t[0] in "'\"`" else t.upper(), at))
        depth += (t == "(") - (t == ")")
    return out


def joined(toks: list[str]) -> str:
    """Tokens as text: no space around brackets and commas, but after a closing one."""
    return "".join(t if i == 0 or t in ("(", ",", ")") or toks[i - 1] in ("(", ",") else f" {t}" for i, t in enumerate(toks))


def closing(item: list[str]) -> int:
    """Place behind the bracket that closes an item's first one."""
    depth = 0
    for i, t in enumerate(item):
        depth += (t == "(") - (t == ")")
        if t == ")" and depth == 0:
            return i + 1
    return len(item)


def key_of(item: list[str]) -> list[str] | None:
    """The columns of an item that is the primary key: between its brackets, without sizes and directions."""
    if not KEYED.match(" ".join(item)):
        return None
    names = item[item.index("(") + 1 :] if "(" in item else item
    return [unquoted(t).lower() for t in names if t.upper() not in NO_KEY and not NUMBER.fullmatch(t)]


def column_of(item: list[str], key: list[str]) -> tuple:
    """The fields of ``ROW`` but the ordinal."""
    o = outside(item)
    words = [w for w, _ in o]
    pairs = set(zip(words, words[1:], strict=False))
    name = unquoted(item[0])
    kind = joined(item[1 : closing(item)] if item[2:3] == ["("] else item[1:2]).lower() + (" unsigned" if "UNSIGNED" in words else "")
    is_pk = ("PRIMARY", "KEY") in pairs or name.lower() in key
    default = comment = None
    if "DEFAULT" in words:  # up to the next word of another clause
        begin = o[words.index("DEFAULT")][1]
        default = joined(item[begin + 1 : next((at for w, at in o if at > begin + 1 and w in AFTER_DEFAULT), len(item))])
    if "COMMENT" in words:
        comment = next(map(unquoted, item[o[words.index("COMMENT")][1] + 1 :]), None)
    return name, kind, ("NOT", "NULL") not in pairs and not is_pk, "AUTO_INCREMENT" in words, ("GENERATED", "ALWAYS") in pairs or "AS" in words, is_pk, default, comment


def columns_of(ddl: str | None) -> list[tuple]:
    """The columns of a text in their order."""
    every = items(tokens(ddl or ""))
    key = max((k for k in map(key_of, every) if k), default=[])
    return [column_of(x, key) for x in every if x[0].upper() not in NO_COLUMN]


def columns(ddl: DataFrame) -> DataFrame:
    """(tbl, ordinal, column, type, nullable, auto, generated, is_pk, default, comment): a row per column of (tbl, ddl).

    ``type`` is in lower case with its sizes and ``unsigned``; ``default`` is the declared text, null where
    there is none; ``comment`` is without quotes. Keys may stand at the column or after the columns; they
    are never nullable. Texts without columns, and null ones, give no row.
    """
    kinds = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in ROW.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, rows = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                found = columns_of(text)
                own += [i] * len(found)
                rows += [(n, *c) for n, c in enumerate(found, 1)]
            cols = list(zip(*rows, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own, pa.int64())), *(pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True))], ["tbl", *(n for n, _ in fields)])

    spark = ddl.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = ", ".join(f"`{n}` {k}" for n, k in (x.split() for x in ROW.split(", ")))
    return ddl.select("tbl", "ddl").repartition(tasks).mapInArrow(run, f"tbl {ddl.schema['tbl'].dataType.simpleString()}, {named}")
