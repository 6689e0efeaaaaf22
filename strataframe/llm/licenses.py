"""License scans: a positional index of rare licence words.

Every template is a run of words with key phrases that must stand in it.  Inverse document
frequencies of all template words come from all documents.  For a template the index posts the two
rarest places of its key phrases: in a file that has the phrases these are its rarest licence words
of that template.  A file's hits name a template and the place where it would start; places that
both words name are candidates, and a candidate counts when all key phrases stand at their places.
Since every key phrase has its rarest words, a file that has the phrases always has the candidate:
frequencies decide what is looked up, never what is found, so no row's labels depend on others.

Only DataFrame functions are used.  The text is scanned whole; null and blank texts have no words
and no labels; repeated rows are scanned alike; an empty table gives an empty result; other
columns are ignored.  Words are split as ``NOT_WORD`` says after lower-casing A-Z.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import staged
from strataframe.llm.quality import bound

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# fixed values: phrases whose places are counted, and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# fixed values: sentences by which texts refer to public licences
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("hereby granted free of charge",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "this program is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Template("reserved", "copyright all rights reserved", ("all rights reserved",)),
    Template("apache-2.0", "spdx license identifier apache 2 0", ("spdx license identifier apache 2 0",)),
    Template("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    Template("gpl-2.0", "spdx license identifier gpl 2 0", ("spdx license identifier gpl 2 0",)),
    Template("gpl-3.0", "spdx license identifier gpl 3 0", ("spdx license identifier gpl 3 0",)),
    Template("bsd", "spdx license identifier bsd", ("spdx license identifier bsd",)),
    Template("later-version", "at your option any later version", ("any later version",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    Template("artistic-2.0", "licensed under the artistic license 2 0", ("artistic license",)),
    Template("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("zlib", "in no event will the authors be held liable for any damages", ("in no event will the authors be held liable",)),
)


VOTES = 2  # places of a template that must agree
START = 1 << 20  # added to places, so that a template may begin before the text


def known_words(templates) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()} | {w for p in BASE for w in p.split()})


def licence_words(docs: DataFrame, *carry: str, templates=TEMPLATES) -> DataFrame:
    """Number of words and, word by word, those that templates or base phrases use; null for all others."""
    # full lower-casing moves no word's border and changes no other letter into A-Z but the Kelvin sign
    low = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u00a7")))
    words = docs.select(*carry, F.array_remove(F.split(low, NOT_WORD), "").alias("_words"))
    return words.select(*carry, F.size("_words").cast("long").alias("n_words"), F.transform("_words", lambda w: F.when(w.isin(*known_words(templates)), w)).alias("words"))


def key_places(template: Template) -> list[tuple[int, list[str]]]:
    """Where each key phrase stands in the template, and its words."""
    own, out = template.text.split(), []
    for phrase in template.phrases:
        words = phrase.split()
        out.append((next(i for i in range(len(own)) if own[i : i + len(words)] == words), words))
    return out


def rare_word_index(rows: DataFrame, templates=TEMPLATES) -> dict[str, list[tuple[int, int]]]:
    """Word to the templates and places it is posted for: the two rarest places of a template's key phrases, by all rows."""
    counts = rows.select(F.explode(F.array_distinct("words")).alias("w")).filter("w is not null").groupBy("w").count()
    df = {r.w: r["count"] for r in counts.collect()}  # one row per word of the templates
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        places = sorted({(df.get(w, 0), first + k, w) for first, words in key_places(template) for k, w in enumerate(words)})[:VOTES]
        for _, p, w in places * (VOTES // len(places)):  # a phrase of one word votes twice
            index.setdefault(w, []).append((t, p))
    return index


def _places(words: list[str], first: int = 0) -> Column:
    return F.array(*[F.struct(F.lit(first + p).alias("p"), F.lit(w).alias("w")) for p, w in enumerate(words)])


def _literal(entries: list[tuple[object, Column]]) -> Column:
    return F.create_map(*[x for k, v in entries for x in (F.lit(k), v)])


def license_scan(docs: DataFrame, *carry: str, templates=TEMPLATES) -> DataFrame:
    """``carry``, words, base places, base labels, all labels, score and the matches (label, start) of every document."""
    rows = staged(licence_words(docs, *carry, templates=templates), "licence-words")
    index = rare_word_index(rows, templates)
    at = lambda i: F.get("words", i)

    def base_at(w: Column, i: Column) -> Column:
        which = F.when(F.lit(False), F.lit(""))
        for phrase, label in BASE.items():
            first, *rest = phrase.split()
            for k, other in enumerate(rest, 1):
                same = at(i + k) == other if k == 1 else same & (at(i + k) == other)
            which = which.when((w == first) & same, F.lit(label))
        return F.when(w.isNotNull() & which.isNotNull(), F.struct(i.alias("at"), which.alias("label")))

    found = lambda use: F.filter(F.transform("words", use), lambda h: h.isNotNull())
    index_words = sorted(index)
    postings = _literal([(w, F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in index[w]])) for w in index_words])
    hits = found(lambda w, i: F.when(w.isin(*index_words), F.struct(i.alias("at"), w.alias("w"))))
    scanned = rows.select(*carry, "n_words", "words", found(base_at).alias("base"), hits.alias("hits"))

    # each hit names a template and the place where it would start, packed into one number
    pack = lambda t, place: t.cast("long") * (1 << 40) + place + START
    named = F.flatten(F.transform("hits", lambda h: F.transform(F.element_at(postings, h["w"]), lambda e: pack(e["t"], h["at"] - e["p"]))))
    agreed = lambda s: F.array_distinct(F.filter(s, lambda v, i: v == F.get(s, i + VOTES - 1)))
    voted = scanned.select(*carry, "n_words", "words", "base", F.when(F.size("hits") > 0, bound(F.sort_array(named), agreed)).alias("votes"))

    phrases = _literal([(t, F.flatten(F.array(*[_places(words, first) for first, words in key_places(x)]))) for t, x in enumerate(templates)])
    whole = _literal([(t, _places(x.text.split())) for t, x in enumerate(templates)])
    labels = F.array(*[F.lit(t.label) for t in templates])
    stands = lambda q, start: F.coalesce(at((start + q["p"]).cast("int")) == q["w"], F.lit(False))

    def match(v: Column) -> Column:
        t, start = F.shiftright(v, 40).cast("int"), v.bitwiseAND(F.lit((1 << 40) - 1)) - START
        share = F.size(F.filter(F.element_at(whole, t), lambda q: stands(q, start))) / F.size(F.element_at(whole, t))
        return F.when(F.forall(F.element_at(phrases, t), lambda q: stands(q, start)), F.struct(F.get(labels, t).alias("label"), start.alias("start"), share.alias("share")))

    matched = voted.select(*carry, "n_words", "base", F.coalesce(F.filter(F.transform("votes", match), lambda m: m.isNotNull()), F.array()).alias("matches"))
    joined = lambda *parts: F.array_join(F.array_sort(F.array_distinct(F.concat(*parts))), ",")
    base = F.col("base.label")
    return matched.select(
        *carry, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.at").cast("long").alias("first_word"), F.array_max("base.at").cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(base, F.col("matches.label")).alias("labels"),
        F.coalesce(F.array_max("matches.share"), F.lit(0.0)).alias("score"), "matches",
    )
