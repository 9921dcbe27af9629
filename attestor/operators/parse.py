"""Sequential parsers, one document a row: their state runs along a document's lines, so they are table functions.

Each takes (key, text) rows and gives (key, ...) rows through mapInPandas; a document must fit in memory, a table not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions.canon import CJK, strip_notes


def _documents(df: DataFrame, key: str, text: str, schema: str, rows: Callable[[str], Iterator[tuple]]) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    names = [key, *[c.split()[0] for c in schema.split(", ")]]

    def run(batches):
        for pdf in batches:
            out = [(k, *r) for k, t in zip(pdf[key], pdf[text], strict=True) for r in rows(t or "")]
            yield pd.DataFrame(out, columns=names)

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, {schema}")


_DEFINE = re.compile(r"^\s*#\s*define\s+([A-Za-z_]\w*)\s+(.+?)\s*(?:/\*.*|//.*)?$")
_IF = re.compile(r"^\s*#\s*(if|ifdef|ifndef|elif|else|endif)\b\s*(.*?)\s*(?:/\*.*|//.*)?$")


def defines(text: str) -> Iterator[tuple[int, str, str, str]]:
    """(line, name, value, condition) of every definition, with the conditions that enclose it, outermost first."""
    stack: list[list[str]] = []
    for n, line in enumerate(text.splitlines(), 1):
        if m := _IF.match(line):
            kind, condition = m.groups()
            if kind in ("if", "ifdef", "ifndef"):
                stack.append([condition if kind == "if" else f"{'!' * (kind == 'ifndef')}defined({condition})"])
            elif kind == "endif":
                if stack:
                    stack.pop()
            elif stack:
                earlier = [c if c.startswith("!(") else f"!({c})" for c in stack[-1]]
                stack[-1] = [*earlier, *([condition] if kind == "elif" else [])]
        elif m := _DEFINE.match(line):
            guards = [" && ".join(s) for s in stack if not re.fullmatch(r"!defined\(_*\w+_H_*\)", s[0])]
            yield n, m.group(1), m.group(2), " && ".join(guards)


def tree_paths(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(line, depth, path, leaf) of a text that shows a tree by indentation or by branch characters."""
    found, stack = [], []
    for n, line in enumerate(text.splitlines(), 1):
        bare = re.sub(r"^[\s│├└─|`+\\-]*", "", line)
        if not bare.strip():
            continue
        indent = len(line) - len(bare)
        while stack and stack[-1][0] >= indent:
            stack.pop()
        stack.append((indent, bare.strip()))
        found.append((n, len(stack), "/".join(s for _, s in stack)))
    for i, (n, depth, path) in enumerate(found):
        yield n, depth, path, i + 1 == len(found) or found[i + 1][1] <= depth


_CELL = re.compile(r"<t([dh])\b[^>]*>(.*?)(?=<t[dhr]\b|</t[dhr]|</table|\Z)", re.S | re.I)


def html_cells(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(table, row, column, text) of the cells of a page's tables."""
    import html

    for t, table in enumerate(re.findall(r"<table\b.*?(?:</table>|\Z)", text, re.S | re.I)):
        for r, row in enumerate(re.split(r"<tr\b[^>]*>", table, flags=re.I)[1:]):
            for c, (_, cell) in enumerate(_CELL.findall(row)):
                yield t, r, c, " ".join(html.unescape(re.sub(r"<[^>]+>", " ", cell)).split())


_ASSIGN = re.compile(r"^\s*(?:[A-Za-z_][\w\s*]*?)?\b([A-Za-z_]\w*)\s*(\|=|&=|=)\s*([^;=][^;]*);")


def register_writes(text: str) -> Iterator[tuple[int, str, str, str]]:
    """(line, register, operator, value) of assignments, with local names resolved to what they were last set to."""
    known: dict[str, str] = {}
    for n, line in enumerate(text.splitlines(), 1):
        if m := _ASSIGN.match(line):
            name, op, value = m.groups()
            if re.match(r"^&?[A-Z][A-Z0-9_]*(->|\.)\w+$", value.strip()):
                known[name] = value.strip().lstrip("&")
            yield n, known.get(name, name), op, value.strip()


def scan_defines(df: DataFrame, key: str, text: str) -> DataFrame:
    return _documents(df, key, text, "line int, name string, value string, condition string", defines)


def scan_tree(df: DataFrame, key: str, text: str) -> DataFrame:
    return _documents(df, key, text, "line int, depth int, path string, leaf boolean", tree_paths)


def scan_cells(df: DataFrame, key: str, text: str) -> DataFrame:
    return _documents(df, key, text, "table int, row int, column int, cell string", html_cells)


def scan_writes(df: DataFrame, key: str, text: str) -> DataFrame:
    return _documents(df, key, text, "line int, register string, op string, value string", register_writes)


def resplit(df: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """Words that were run together, cut again by a vocabulary: the longest word that fits, else one character more."""
    words = sorted(set(vocabulary), key=lambda w: (-len(w), w))

    def rows(t: str):
        out, i, loose = [], 0, ""
        while i < len(t):
            w = next((w for w in words if t.startswith(w, i)), None)
            if w is None:
                loose += t[i]
                i += 1
                continue
            if loose:
                out.append(loose)
                loose = ""
            out.append(w)
            i += len(w)
        if loose:
            out.append(loose)
        yield (" ".join(x.strip() for x in out if x.strip()),)

    return _documents(df, key, text, "pieces string", rows)


def _leaves(x) -> Iterator[tuple[str, str | None]]:
    """(key, value) of every leaf of nested mappings and lists, with dotted keys; items of lists by their number."""
    stack = [("", x)]
    while stack:
        name, x = stack.pop()
        if isinstance(x, (dict, list)):
            pairs = x.items() if isinstance(x, dict) else enumerate(x)
            stack += [(f"{name}.{k}" if name else str(k), v) for k, v in pairs][::-1]
        elif name:
            yield name, None if x is None else str(x)


def scan_yaml(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, value) of every leaf of YAML documents."""

    def rows(t: str):
        import yaml

        yield from _leaves(yaml.safe_load(t))

    return _documents(df, key, text, "key string, value string", rows)


def scan_json(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, value) of every leaf of JSON documents of any shape; what can't be parsed has none."""

    def rows(t: str):
        import json

        try:
            yield from _leaves(json.loads(t))
        except ValueError:
            return

    return _documents(df, key, text, "key string, value string", rows)


def lines_of_words(df: DataFrame, group: list[str], x: str, y: str, word: str, apart: float) -> DataFrame:
    """(group, y, line) of words with coordinates: those less than `apart` below the one before stand on its line."""
    down = Window.partitionBy(*group).orderBy(y, x)
    new = F.when(F.col(y) - F.lag(y).over(down) < apart, 0).otherwise(1)
    marked = df.withColumn("_new", new).withColumn("_line", F.sum("_new").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.transform(F.array_sort(F.collect_list(F.struct(F.col(x).alias("x"), F.col(word).alias("w")))), lambda s: s["w"])
    return marked.groupBy(*group, "_line").agg(F.min(y).alias("y"), F.array_join(words, " ").alias("line")).drop("_line")


def vocabulary(df: DataFrame, cell: str, stem: str) -> DataFrame:
    """(kind, word, n): what cells spell out where the ends are certain, in parts between '/' without a line break.

    `stem` words are what a part begins with, by the pattern's group; `name` words whole parts without notes or spaces.
    """
    parts = df.select(F.explode(F.split(cell, "/")).alias("_p")).where(~F.contains("_p", F.lit("\n"))).select(F.trim("_p").alias("_p"))
    name = strip_notes("_p")
    both = parts.select(F.explode(F.array(F.struct(F.lit("stem").alias("kind"), F.regexp_extract("_p", stem, 1).alias("word")), F.struct(F.lit("name").alias("kind"), F.when(~F.contains(name, F.lit(" ")) & ~name.rlike(CJK), name).alias("word")))).alias("w")).select("w.*")
    return both.where("word <> ''").groupBy("kind", "word").agg(F.count("*").alias("n"))
