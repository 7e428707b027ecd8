"""License scan by a positional index of rare template words.

Templates are short wordings of licenses; each has key phrases that must stand in the text. Word frequencies of all documents
give every template word an IDF. Only the anchors have postings (template, position): the rarest word of each key phrase, chosen once for
all documents. A posting meets the word's places in the document, which gives the relative position (place minus position) at which
a template may stand; as a key phrase holds its anchor, no place is missed. A place counts if its key phrase stands there
consecutively, and scores by the template's words that stand at that relative position. Both are found by comparing words: the other
words have no postings, and none are intersected.

Words: runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. A null or empty text has no words and no labels. A very
long text is one row's work. Rows are independent: copies and repeated ids give the same result each; ties of IDF go to the
earlier position. Other columns are dropped. Over no documents the result is empty.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import WORD_BYTES, as_bytes


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: stands consecutively in every place
    key: str
    base: bool = False


#: Phrases and labels.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("gpl", "this work is licensed under the gnu general public license version", "gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    Template("cc0", "released under cc0 1 0 universal", "cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
#: Anchors of a place: so many of the rarest words of the key phrase are looked up.
ANCHORS = 1


def document_frequency(docs: DataFrame, words: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Rows, and rows that hold each of the given words; the words' number bounds what comes back."""

    def run(batches):
        rows, df = 0, defaultdict(int)
        for b in batches:
            for text in as_bytes(b.column("text")):
                rows += 1
                for w in words.intersection(text.translate(WORD_BYTES).split()):
                    df[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([b"", *df], pa.binary()), pa.array([rows, *df.values()], pa.int64())], names=["word", "n"])

    got = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {bytes(r["word"]): r["n"] for r in got}
    return counts.pop(b"", 0), counts


class Index:
    """Postings of template words with IDF weights, and each template's anchor."""

    def __init__(self, templates: tuple[Template, ...], rows: int, df: dict[bytes, int]):
        self.templates = templates
        self.words = [t.text.encode().split() for t in templates]
        self.keys = [t.key.encode().split() for t in templates]
        self.at = [next(i for i in range(len(w)) if w[i : i + len(k)] == k) for w, k in zip(self.words, self.keys)]
        self.idf = {w: 1 + math.log((rows + 1) / (df.get(w, 0) + 1)) for ws in self.words for w in ws}
        self.anchors: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (key, at) in enumerate(zip(self.keys, self.at)):
            for i in sorted(range(len(key)), key=lambda i: (-self.idf[key[i]], i))[:ANCHORS]:
                self.anchors[key[i]].append((t, at + i))
        self.total = [sum(self.idf[w] for w in ws) for ws in self.words]

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, place of the key phrase, share of the template's IDF that stands there) of every place."""
        present = sorted(self.anchors.keys() & set(words), key=lambda w: (-self.idf[w], w))
        if not present:
            return []
        wanted, places = set(present), defaultdict(list)
        for i, w in enumerate(words):
            if w in wanted:
                places[w].append(i)
        found = []
        for w in present:
            for t, position in self.anchors[w]:
                key, at, text = self.keys[t], self.at[t], self.words[t]
                for place in places[w]:
                    begin = place - position  # the template's place; its head may lie before the text
                    first = begin + at
                    if first >= 0 and words[first : first + len(key)] == key:
                        here = sum(self.idf[x] for j, x in enumerate(text) if 0 <= begin + j < len(words) and words[begin + j] == x)
                        found.append((t, first, min(1.0, here / self.total[t])))
        return sorted(found)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<label:string,word:long,score:double>>"


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of docs (doc_id, text): labels, base places, best score (0 without places) and all places."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    vocabulary = {w for t in templates for w in t.text.encode().split()}
    index = Index(templates, *document_frequency(docs, vocabulary))

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text"))):
                words = text.translate(WORD_BYTES).split()
                found = index.scan(words)
                base = sorted(p for t, p, _ in found if templates[t].base)
                labels = lambda some: ",".join(sorted({templates[t].label for t, *_ in some}))
                rows.append({
                    "doc_id": doc_id, "n_words": len(words), "n_base": len(base), "first_word": base[0] if base else None,
                    "last_word": base[-1] if base else None, "base_labels": labels(x for x in found if templates[x[0]].base),
                    "labels": labels(found), "score": max((s for *_, s in found), default=0.0),
                    "places": [{"label": templates[t].label, "word": p, "score": s} for t, p, s in found]})
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return docs.mapInArrow(run, SCHEMA)


ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("score", pa.float64())])))])
