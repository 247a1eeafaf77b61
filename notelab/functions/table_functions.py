"""a table function from a note to many spans, and F04: a Python function
mapped over rows in parallel.

``span_function`` makes a Python table function of named taggers.  Its result
has the columns ``group, start, end, lexical_variant`` and one column per
extension asked for, so the schema depends on the (constant) arguments of the
call:

    spark.udtf.register("note_spans", span_function(TAGGERS, EXTENSIONS))
    select d.doc_id, x.* from documents d, lateral note_spans(d.text, 'dates,numbers', 'value') x

Each note is one call; notes are dealt to tasks as Spark reads them and nothing
is shuffled.  A null note has no spans; an unknown group or extension is an error
when the query is planned.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, UserDefinedTableFunction

#: A tagger yields (start, end, values by extension) for a note.
Tagger = Callable[[str], Iterable[tuple[int, int, Mapping[str, Any]]]]


def regex_tagger(pattern: str, **extensions: Callable[[re.Match], Any]) -> Tagger:
    """Spans of a pattern's matches; ``extensions`` compute values from a match."""
    compiled = re.compile(pattern, re.ASCII)

    def tag(note: str) -> Iterator[tuple[int, int, dict[str, Any]]]:
        for m in compiled.finditer(note):
            yield m.start(), m.end(), {name: fn(m) for name, fn in extensions.items()}

    return tag


NUMBER = r"\b[0-9]+(?:[.,][0-9]+)?\b"
DATE = r"\b([0-3]?[0-9])/([01]?[0-9])/([0-9]{4})\b"
TAGGERS: dict[str, Tagger] = {
    "numbers": regex_tagger(NUMBER, value=lambda m: float(m[0].replace(",", "."))),
    "dates": regex_tagger(DATE, norm=lambda m: f"{m[3]}-{m[2]:0>2}-{m[1]:0>2}"),
}
EXTENSIONS: dict[str, DataType] = {"value": DoubleType(), "norm": StringType()}


@cache
def _names(text: str | None) -> tuple[str, ...]:
    return tuple(x.strip() for x in (text or "").split(",") if x.strip())


def span_function(taggers: Mapping[str, Tagger], extensions: Mapping[str, DataType]) -> UserDefinedTableFunction:
    """The table function ``f(note, groups, extensions)``; the last two are
    comma-separated constants."""
    taggers, extensions = dict(taggers), dict(extensions)

    class NoteSpans:
        @staticmethod
        def analyze(note: AnalyzeArgument, groups: AnalyzeArgument, wanted: AnalyzeArgument) -> AnalyzeResult:
            for argument, known, what in ((groups, taggers, "span group"), (wanted, extensions, "extension")):
                if not argument.isConstantExpression:
                    raise ValueError(f"the list of {what}s must be constant")
                for name in _names(argument.value):
                    if name not in known:
                        raise ValueError(f"unknown {what}: {name}")
            schema = StructType().add("group", StringType()).add("start", IntegerType()).add("end", IntegerType())
            schema = schema.add("lexical_variant", StringType())
            for name in _names(wanted.value):
                schema = schema.add(name, extensions[name])
            return AnalyzeResult(schema)

        def eval(self, note: str, groups: str, wanted: str) -> Iterator[tuple]:
            names = _names(wanted)
            for group in _names(groups) if note is not None else []:
                for start, end, values in taggers[group](note):
                    yield (group, start, end, note[start:end], *(values.get(n) for n in names))

    return F.udtf(NoteSpans)


def note_spans(notes: DataFrame, text: str, groups: Iterable[str], extensions: Iterable[str] = (),
               taggers: Mapping[str, Tagger] | None = None, types: Mapping[str, DataType] | None = None) -> DataFrame:
    """The columns of ``notes`` with those of the table function, a row a span."""
    fn = span_function(TAGGERS if taggers is None else taggers, EXTENSIONS if types is None else types)
    return notes.lateralJoin(fn(F.col(f"`{text}`").outer(), F.lit(",".join(groups)), F.lit(",".join(extensions))))


def parallel_map(df: DataFrame, fn: Callable[..., Any], columns: list[str], name: str, returns: str) -> DataFrame:
    """``df`` with one more column ``name``, ``fn`` of the values of
    ``columns`` row by row.  Rows go to Python in Arrow batches on all tasks; for
    what expressions cannot say."""
    def run(*values: pd.Series) -> pd.Series:
        return pd.Series([fn(*row) for row in zip(*values, strict=True)], dtype=object)

    mapped: Column = F.pandas_udf(run, returns)(*(F.col(f"`{c}`") for c in columns))
    return df.withColumn(name, mapped)


def row_expressions(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """columns from SQL row expressions (higher-order functions included),
    in the order given; a later one may use an earlier one."""
    for name, expression in columns.items():
        df = df.withColumn(name, F.expr(expression))
    return df
