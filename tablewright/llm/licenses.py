"""Licence scans: normalised lines and passages against licence templates by the Dice coefficient of word bigrams.

A line is one unit. A passage is a run of words anywhere in the text, within a line or over several: so notices that are
wrapped or stand in prose are found, and whole licence texts by their headings, grants and notices. A unit with p distinct
bigrams and a template with q have a coefficient of at most 2 min(p, q) / (p + q): a unit that reaches the least
coefficient holds so many of the template's bigrams that it cannot do without all of some words. Texts without any of
these words are passed over, in the others only places where bigrams of templates stand are compared.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.session import small_frame

#: Notices by which works state their licence, and the short licences' own opening grants.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    # headings of whole licence texts
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International Public License"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International Public License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
]


#: A line or passage that matches: minus its coefficient, minus the template's bigrams, the places of its first and last word.
UNIT = "struct<passage:boolean,d:double,nq:int,template:int,at:int,stop:int,line:int,license:string>"


def template_frame(spark: SparkSession) -> DataFrame:
    return small_frame(spark, [(i, n, t) for i, (n, t) in enumerate(TEMPLATES)], "template int, license string, text string")


def normalised(text: Column) -> Column:
    """A-Z lower-cased; everything but a-z and 0-9 separates words."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def bigrams(clean: Column) -> Column:
    """The distinct pairs of neighbouring words; a single word is its own pair, no word none."""
    words = F.split(clean, " ")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(clean == "", F.array().cast("array<string>")).when(F.size(words) == 1, words).otherwise(
        F.array_distinct(F.filter(pairs, lambda p: p.isNotNull())))


def _key_words(known: list, least: float) -> list[str]:
    """Words of which every unit that reaches ``least`` with some template holds one: without them too many bigrams lack."""
    chosen: list[str] = []
    for t in known:
        left, lost = set(t["t"]), 0
        words = {w for g in t["t"] for w in g.split(" ")}
        while lost <= len(t["t"]) * (1 - least / (2 - least)) + 1e-9:
            gone = {w: sum(w in g.split(" ") for g in left) for w in words}
            best = max((w for w in words if gone[w]), key=lambda w: (w in chosen, len(w), w))
            lost += gone[best]
            left = {g for g in left if best not in g.split(" ")}
            words.discard(best)
            if best not in chosen:
                chosen.append(best)
    return chosen


def _text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for the value, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _units(text: str, known: list, least: float) -> str:
    """SQL for the array of units (line, license, template, dice) of one text."""
    share = least / (2 - least)
    items = [(t["template"], t["license"], t["t"], t["n"] - 1, max(1, math.ceil(len(t["t"]) * share - 1e-9))) for t in known]
    names = "array({})".format(", ".join(
        f"named_struct('template', {i}, 'license', {_text_sql(n)}, 'q', {len(g)}, 'need', {need}, 'span', {int(pairs / share + 1e-9)}, 'g', array({', '.join(map(_text_sql, g))}))"
        for i, n, g, pairs, need in items))
    every = ", ".join(sorted({_text_sql(g) for _, _, gs, _, _ in items for g in gs}))
    low = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    by_line = f"transform(split({text}, '\n', -1), l -> filter(split(regexp_replace({low}, '[^a-z0-9]+', ' '), ' '), w -> w <> ''))"

    def pairs(w: str) -> str:
        return f"if(size({w}) < 2, cast(array() as array<string>), zip_with(slice({w}, 1, greatest(size({w}) - 1, 0)), slice({w}, 2, greatest(size({w}) - 1, 0)), (x, y) -> concat(x, ' ', y)))"

    def dice(g: str) -> str:
        return f"(2.0D * size(array_intersect({g}, t.g))) / (size({g}) + t.q)"

    hits = f"filter(transform(g, (x, i) -> if(x in ({every}), named_struct('at', i + 1, 'g', x), null)), x -> x is not null)"
    # order: the first of equals is the better; whole lines stand before all passages
    unit = "named_struct('passage', {}, 'd', -({}), 'nq', -t.q, 'template', t.template, 'at', {}, 'stop', {}, 'line', {}, 'license', t.license)"
    # a single word is a line's own bigram
    alone = any(" " not in g for _, _, gs, _, _ in items for g in gs)
    places = "sequence(0, size(b) - 1)" if alone else "array_distinct(transform(hits, h -> line[h.at - 1]))"
    of_line = unit.format("false", dice("lg"), "0", "0", "i").replace("'nq', -t.q", "'nq', 0")
    best = f"array_min(filter(transform(t_all, t -> {of_line}), u -> u.d <= -{least}D))"
    lines = (f"transform(filter(transform({places}, i -> " + _let(f"if(size(b[i]) = 1, b[i], array_distinct({pairs('b[i]')}))", "lg", f"if(size(lg) = 0, null, {best})")
             + "), u -> u is not null), u -> named_struct('passage', false, 'd', u.d, 'nq', 0, 'template', u.template, 'at', cast(array_position(line, u.line) as int), "
             "'stop', cast(array_position(line, u.line) as int) + size(b[u.line]) - 1, 'line', u.line, 'license', u.license))")
    # a passage starts and ends with a bigram of its template: others at its ends only make it worse
    window = _let("array_distinct(slice(g, own[s].at, own[e].at - own[s].at + 1))", "pg",
                  unit.format("true", dice("pg"), "own[s].at", "own[e].at + 1", "line[own[s].at - 1]"))
    ends = "filter(sequence(s + t.need - 1, least(size(own) - 1, s + t.span - 1)), e -> own[e].at - own[s].at < t.span)"
    starts = "sequence(0, size(own) - t.need)"
    tried = (f"if(size(array_distinct(transform(own, h -> h.g))) < t.need, cast(array() as array<{UNIT}>), "
             f"flatten(transform({starts}, s -> filter(transform(if(s + t.need - 1 > least(size(own) - 1, s + t.span - 1), cast(array() as array<int>), {ends}), e -> {window}), u -> u.d <= -{least}D))))")
    passages = "sort_array(flatten(transform(t_all, t -> " + _let("filter(hits, h -> array_contains(t.g, h.g))", "own", tried) + ")))"
    common = "(least(a.stop, u.stop) - greatest(a.at, u.at) + 1)"
    alike = f"({common} > 0 and (a.license = u.license or 2 * {common} > u.stop - u.at))"
    gives_way = f"({alike} and (a.passage or a.d <= u.d or (a.license = u.license and a.at <= u.at and u.stop <= a.stop)))"
    chosen = f"aggregate({passages}, cast({lines} as array<{UNIT}>), (kept, u) -> if(exists(kept, a -> {gives_way}), kept, concat(kept, array(u))))"
    found = chosen if alone else f"if(size(hits) = 0, cast(array() as array<{UNIT}>), {chosen})"
    return _let(names, "t_all", _let(by_line, "b", _let("flatten(b)", "w", _let(pairs("w"), "g", _let(
        "flatten(transform(b, (x, i) -> array_repeat(i, size(x))))", "line", _let(hits, "hits", found))))))


def scan(docs: DataFrame, templates: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, line_no, license, template, dice: each line and each passage of each text that reaches ``least``.

    Lines end at line feeds and are counted from 0. The best template of a line has the highest coefficient (ties: the
    lowest template number); one row per line that has one. A passage is a run of words, of at most (2 - least) / least
    times as many as the template has, and line_no the line of its first word. Passages are taken best first (highest
    coefficient, then longest template); one gives way to an earlier one that overlaps it, or to a line that is no worse,
    if both name the same licence or half of it or more is covered; within a line of its own licence it is not repeated. Null and
    empty texts have no units that match. Rows that repeat an id and text give their units once; different texts under
    one id are told apart by the text's digest, and their units listed side by side. Other columns are not returned.
    The driver gathers the templates, which become part of the plan.
    """
    clean = normalised(F.col("text"))
    known = templates.select("template", "license", bigrams(clean).alias("t"), F.size(F.split(clean, " ")).alias("n")).where(F.size("t") > 0).orderBy("template").collect()
    if known:
        low = F.lower(F.col(text))
        near = functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in _key_words(known, least)])
        units = F.expr(_units(f"`{text}`", known, least))
    else:
        near, units = F.lit(False), F.lit(None).cast(f"array<{UNIT}>")
    found = docs.where(near).select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("copy"), F.explode(units).alias("u"))
    # copies of a row repeat their units
    once = found.select("id", "copy", "u.line", "u.license", "u.template", (-F.col("u.d")).alias("dice"), "u.at").distinct()
    return once.select(F.col("id").alias(doc_id), F.col("line").alias("line_no"), "license", "template", "dice")
