"""Licences named in documents, by known sentences and ordered rules; DataFrame functions only.

A text is cut into sentences (at a full stop, question or exclamation mark before a
blank, and at empty lines) and, for notices that stand alone, into lines. Sentences are
normalised (lower case, letters and digits, single blanks) and looked up among the known
ones; the identifiers found, in order, are matched against the rules, each rule taking
away what it used. All of it is one projection: no shuffle, no state, whole texts.

Defined cases: NULL and empty texts name nothing. Sentences between known ones do not
separate them. A line counts only if no sentence gave its identifier. Every row is
scanned, repeated ones too; other columns are passed on, but ``licenses`` and
``sentence_ids`` replace columns of these names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.license_texts import RULES, SENTENCES

BLANK = r"[ \t\n\x0b\f\r]"
SENTENCE_END = rf"[.!?]+{BLANK}+|\n{BLANK}*\n"


def normal_form(sentence: str) -> str:
    """What ``normalised`` makes of a known (ASCII) sentence."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


KNOWN = {normal_form(text): name for name, texts in SENTENCES.items() for text in texts}


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def identifiers(units: Column) -> Column:
    """Known identifiers of the units, in order."""
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    return F.filter(F.transform(units, lambda s: F.try_element_at(known, normalised(s))), lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Rows whose text has a known sentence, with ``licenses`` (sorted names) and ``sentence_ids`` (in order)."""
    text = F.col(text_col)
    sentences = identifiers(F.split(text, SENTENCE_END, -1))
    lines = identifiers(F.split(text, "\n", -1))
    found = docs.withColumn("sentence_ids", F.concat(sentences, F.array_except(lines, sentences)))
    found = found.where(F.size("sentence_ids") > 0)
    rest = F.concat(F.lit("|"), F.array_join("sentence_ids", "|"), F.lit("|"))
    names = []
    for name, parts in RULES:
        pattern = F.lit(f"|{'|'.join(parts)}|")
        names.append(F.when(F.contains(rest, pattern), F.lit(name)))
        rest = F.replace(rest, pattern, F.lit("|"))
    return found.withColumn("licenses", F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))))
