"""JSON text taken apart without building what isn't asked for.

``from_json`` into text columns gives each value's own JSON text: the parser
skips what the schema doesn't name, a repeated key keeps its last value, keys
keep their order and their case, and no size limit but that of a text applies.
What it cannot tell is a text that looks like an object from an object. So
texts that begin with a brace are guarded by a leading U+0001 before the parse,
and the guard is taken off the pieces: an unguarded brace is an object.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a JSON text (key or value) that begins with a brace, however written, and
# any guards that it already has
_BRACED = r'"((?:\\u0001)*(?:\{|\\u007[bB]))'
_GUARDED = r'"\\u0001((?:\\u0001)*\{)'


def guard(doc: Column) -> Column:
    """Mark the texts of a JSON document that begin with a brace."""
    seen = F.contains(doc, F.lit('"{')) | F.contains(doc, F.lit('"\\u00'))
    return F.when(seen, F.regexp_replace(doc, _BRACED, r'"\\u0001$1')).otherwise(doc)


def unguard(piece: Column) -> Column:
    """A piece of a guarded document as it was."""
    return F.when(F.contains(piece, F.lit('"\\u0001')), F.regexp_replace(piece, _GUARDED, '"$1')).otherwise(piece)


def is_object(piece: Column) -> Column:
    """Whether a piece of a guarded document is an object."""
    return F.coalesce(F.startswith(piece, F.lit("{")), F.lit(False))


class Paths:
    """Key paths read by as few parses as possible: paths of which one is the
    beginning of another go to different parses. ``leaf`` is the type at the
    end of a path."""

    def __init__(self, paths: Sequence[tuple[tuple[str, ...], T.DataType]]):
        self.trees: list[dict] = []
        self.place = [(self._add(tuple(steps), leaf), tuple(steps)) for steps, leaf in paths]

    def _add(self, steps: tuple[str, ...], leaf: T.DataType) -> int:
        for i, tree in enumerate([*self.trees, {}]):
            at = tree
            for step in steps[:-1]:
                at = at.get(step, {})
                if not isinstance(at, dict):
                    break
            if isinstance(at, dict) and at.get(steps[-1], leaf) == leaf:
                if i == len(self.trees):
                    self.trees.append(tree)
                at = tree
                for step in steps[:-1]:
                    at = at.setdefault(step, {})
                at[steps[-1]] = leaf
                return i
        raise AssertionError("an empty tree takes any path")

    def parses(self, text: Column) -> list[Column]:
        """One parse for each tree. Give each a column of its own and read it
        by ``value``; taken straight off the expression, every field would be
        a parse."""
        return [F.from_json(text, _schema(tree)) for tree in self.trees]

    def value(self, i: int, parsed: Sequence[Column]) -> Column:
        """The value of the ``i``-th path, null where it is absent, null or of
        another type."""
        tree, steps = self.place[i]
        out = parsed[tree]
        for step in steps:
            out = out.getField(step)
        return out


def _schema(tree: dict) -> T.StructType:
    return T.StructType([T.StructField(k, _schema(v) if isinstance(v, dict) else v) for k, v in tree.items()])


def truthy(item: Column, key: str, text: Column) -> Column:
    """Whether the value of ``key`` in a JSON object, parsed into ``text``,
    counts as given: null, ``""``, ``false``, zero, ``[]`` and ``{}`` don't,
    texts such as ``"0"`` do. Only texts that could be either are parsed again,
    by their kind."""

    def of(kind: T.DataType) -> Column:
        return F.from_json(item, _schema({key: kind})).getField(key)

    return (
        F.when(text.isNull() | (text == ""), False)
        .when(F.rlike(text, F.lit(r"^-?0+(\.0*)?([eE][+-]?[0-9]+)?$")), F.coalesce(of(T.DoubleType()) != 0, F.lit(True)))
        .when(text == "false", F.coalesce(of(T.BooleanType()), F.lit(True)))
        .when(text == "[]", of(T.ArrayType(T.StringType())).isNull())
        .when(text == "{}", of(T.MapType(T.StringType(), T.StringType())).isNull())
        .otherwise(True)
    )
