"""Identifier rules as Column expressions, in a form all of Java, Python and RE2 read alike.

A rule keeps its boundaries in groups instead of looking around, so one
spelling serves Spark, pandas and SQL.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IdentifierRule:
    """``pattern`` has the text before the identifier in group 1; ``mask`` replaces the rest.

    A match has one word of each tuple of ``needs`` and a match of ``hint`` in
    it: what is cheap to look for, so that the pattern itself, which tries every
    place of a text, is only run where it can find something.
    """

    kind: str
    pattern: str
    mask: str
    needs: tuple[tuple[str, ...], ...] = ()
    hint: str | None = None

    def count(self, text: Column) -> Column:
        """Matches in a text; null for a null one."""
        tests = [reduce(or_, [F.contains(text, F.lit(w)) for w in words]) for words in self.needs]
        tests += [F.rlike(text, F.lit(self.hint))] if self.hint else []
        found = F.regexp_count(text, F.lit(self.pattern)).cast("long")
        return F.when(~reduce(and_, tests), F.lit(0).cast("long")).otherwise(found) if tests else found


GENERIC = (
    IdentifierRule("SECRET", r"()\b(?:password|passwd|secret|token|api_?key)[ ]*[:=][ ]*[\"']?[A-Za-z0-9+/_.=-]{6,}[\"']?", "[secret]", ((":", "="), ("password", "passwd", "secret", "token", "api_key", "apikey"))),
    IdentifierRule("EMAIL", r"()[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]", (("@",),)),
    IdentifierRule("URL", r"()(?:https?://|www\.)[A-Za-z0-9][A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]*", "[url]", (("://", "www."),)),
    IdentifierRule("IP", r"(^|[^0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", "[ip]", hint=r"[0-9]\.[0-9]"),
    IdentifierRule("CARD", r"()\b[0-9]{16}\b", "[card]", hint="[0-9]{16}"),
    IdentifierRule("PHONE", r"()(?:\+[0-9]{1,2} )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}\b", "[phone]", ((") ",),)),
    IdentifierRule("PLATE", r"(^|[^A-Za-z0-9-])[A-Z0-9]{2,4}-[A-Z0-9]{2,4}\b", "[plate]", (("-",),), "[A-Z0-9]-[A-Z0-9]"),
)


def apply_rules(text: Column, rules: tuple[IdentifierRule, ...] = GENERIC) -> tuple[Column, Column]:
    """The fields of :func:`masked`; where both are wanted, select the struct and take them from it."""
    state = masked(text, rules)
    return state["text"], state["counts"]


def masked(text: Column, rules: tuple[IdentifierRule, ...] = GENERIC) -> Column:
    """Struct of the masked ``text`` and ``counts``, kind -> number of masked values; each rule sees what the ones before left.

    A rule's step is a lambda over the state of the one before: its argument is
    a value, which the optimiser can't replace by the expression it came from, so
    a text is read once a rule to count, where the rule's words are in it, and
    once more where there is something to mask.
    """
    state = F.struct(text.alias("text"), F.array().cast("array<bigint>").alias("counts"))
    for rule in rules:
        counted = then(state, lambda s: F.struct(s["text"].alias("text"), s["counts"].alias("counts"), rule.count(s["text"]).alias("n")))
        state = then(
            counted,
            lambda s: F.struct(
                F.when(s["n"] > 0, F.regexp_replace(s["text"], rule.pattern, "$1" + rule.mask)).otherwise(s["text"]).alias("text"),
                F.concat(s["counts"], F.array(s["n"])).alias("counts"),
            ),
        )
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return then(state, lambda s: F.struct(s["text"].alias("text"), F.map_from_arrays(kinds, s["counts"]).alias("counts")))


def then(state: Column, step) -> Column:
    """``step`` of the value of ``state``, which is evaluated once."""
    return F.get(F.transform(F.array(state), step), F.lit(0))


def leak_counts(text: Column, rules: tuple[IdentifierRule, ...] = GENERIC) -> Column:
    """Map kind -> hits that are still in a text (Q1)."""
    return F.create_map(*[x for r in rules for x in (F.lit(r.kind), r.count(text))])


def squeeze(text: Column) -> Column:
    """Line ends to \\n, runs of blanks to one, at most one empty line, ends trimmed (N1 without Unicode folding)."""
    text = F.regexp_replace(text, r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"\n +", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def replace_longest_first(text: Column, literals: dict[str, str]) -> Column:
    """Literal replacements, longer ones first, equals in their given order."""
    for literal in sorted(literals, key=len, reverse=True):
        text = F.replace(text, F.lit(literal), F.lit(literals[literal]))
    return text


def highlight_spans(text: Column, terms: list[str]) -> Column:
    """Array of (start, end) code point spans of any of the terms, longer ones first, none overlapping."""
    pattern = "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)) if t)
    if not pattern:
        return F.array().cast("array<struct<start:int,end:int>>")

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def spans(texts: pa.Array) -> pa.Array:
        # one search a text; sums over what the engine's own functions find read the text again for every span
        find = re.compile(pattern).finditer
        starts, ends, offsets = array("i"), array("i"), array("i", [0])
        for text in texts.to_pylist():
            for match in find(text or ""):
                starts.append(match.start())
                ends.append(match.end())
            offsets.append(len(starts))
        found = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found, mask=texts.is_null())

    return spans(text)
