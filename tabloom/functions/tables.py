"""Python table functions for SQL."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: Marks of wiki text that open or close a template, a parameter or a comment.
MARKS = re.compile(r"\{{2,}|\}{2,}|<!--|-->")


class TemplateTree:
    """The templates of a page with their nesting: (page, line, depth, template, path), one row per template when its name is complete,
    and for each that never closes a row with its name, a negative depth and the page's last line.

    The argument is a table of lines (page key, line number, text), ``PARTITION BY`` the page and ``ORDER BY`` the line. A template, parameter or
    comment may begin on one line and end on a later one: what is open stays as state over the rows of the page. The page column keeps its
    type. Null lines are empty ones. State is what is open, not the page.
    """

    @staticmethod
    def analyze(lines: AnalyzeArgument) -> AnalyzeResult:
        if not lines.isTable or len(lines.dataType.fields) < 3:
            raise ValueError("the argument is a table of page, line and text")
        page = lines.dataType.fields[0]
        schema = StructType().add("page", page.dataType).add("line", IntegerType()).add("depth", IntegerType()).add("template", StringType()).add("path", StringType())
        return AnalyzeResult(schema=schema)

    def __init__(self):
        self.open: list[list] = []  # name so far, whether it is complete, line; None stands for a parameter
        self.comment, self.page, self.line = False, None, 0

    def _names(self) -> list[str]:
        return [t[0].strip() for t in self.open if t is not None]

    def _complete(self) -> Iterator[tuple]:
        """The innermost template's name ends here."""
        if self.open and self.open[-1] is not None and not self.open[-1][1]:
            top = self.open[-1]
            top[1], name = True, top[0].strip()
            if name and not name.startswith("#"):
                path = self._names()
                yield self.page, top[2], len(path), name, "/".join(path)

    def _text(self, text: str) -> Iterator[tuple]:
        if self.comment or not self.open or self.open[-1] is None or self.open[-1][1]:
            return
        name, bar, _ = text.partition("|")
        self.open[-1][0] += name
        if bar:
            yield from self._complete()

    def _close(self, braces: int) -> Iterator[tuple]:
        """The innermost is closed first, a template by two braces, a parameter by three; braces that close nothing are text."""
        while self.open and braces >= (3 if self.open[-1] is None else 2):
            braces -= 3 if self.open[-1] is None else 2
            yield from self._complete()
            self.open.pop()

    def eval(self, row) -> Iterator[tuple]:
        self.page, self.line, text = row[0], row[1], row[2] or ""
        at = 0
        for mark in MARKS.finditer(text):
            sign = mark.group()
            yield from self._text(text[at : mark.start()])
            at = mark.end()
            if self.comment:
                self.comment = sign != "-->"
            elif sign == "<!--":
                self.comment = True
            elif sign[0] == "{":
                # an odd run ends in a parameter, three braces; all others open templates, two braces
                yield from self._complete()
                odd = len(sign) % 2
                for _ in range(len(sign) // 2 - odd):
                    self.open.append(["", False, self.line])
                if odd:
                    self.open.append(None)
            elif sign[0] == "}":
                yield from self._close(len(sign))
        yield from self._text(text[at:] + "\n")

    def terminate(self) -> Iterator[tuple]:
        for depth, top in enumerate((t for t in self.open if t is not None), 1):
            yield self.page, self.line, -depth, top[0].strip(), None


def register(spark: SparkSession) -> None:
    """Make ``template_tree`` callable from SQL."""
    spark.udtf.register("template_tree", udtf(TemplateTree))
