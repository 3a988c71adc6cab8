"""Find licence statements by the Dice coefficient of word bigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.llm.decontamination import words_of
from sievepoint.llm.text import once, row_keys, whole_text

# Statements and notices as their licences give them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                  "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                  "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                  "following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                      "or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met:",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                      "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def bigrams(words: Column) -> Column:
    """Distinct hashes of neighbouring words; empty for fewer than two words."""
    pair = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1))
    return F.when(F.size(words) > 1, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - 2), pair))).otherwise(
        F.array().cast("array<bigint>"))


def scan_licences(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """Licence statements of each document: doc_id, licences (array of unit, name, dice), licence, dice (the best).

    A text is compared by its lines, its paragraphs where it has blank lines, and as a whole. A unit of a
    bigrams can reach the coefficient ``least`` with a template of b only if a is within b * least / (2 - least)
    and b * (2 - least) / least, so templates out of these bounds are not compared; units without any
    bigram of a template end before that. ``templates`` is a short list of the caller and part of the plan.

    Words are compared with A-Z lower-cased and without punctuation. A NULL or empty text, or one of a single word,
    has no licence; ties go to the name that comes first. Repeated rows come back as often as they are given.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    low, high = least / (2 - least), (2 - least) / least
    listed = spark.createDataFrame(sorted(templates.items()), "name string, text string").select(
        "name", bigrams(words_of(F.col("text"))).alias("b")).collect()  # the templates only
    listed = [r for r in listed if r.b]
    hashes = lambda values: F.array(*(F.lit(v) for v in values)).cast("array<bigint>")
    known = hashes(sorted({h for r in listed for h in r.b}))
    shortest = min((len(r.b) for r in listed), default=0) * low
    longest = max((len(r.b) for r in listed), default=0) * high

    rows = docs.select("doc_id", *row_keys(F.col("doc_id"), F.col("text")), whole_text("text").alias("body"))
    lines = F.split("body", "\n", -1)
    paragraphs = F.when(F.col("body").contains("\n\n"), F.split("body", "\n{2,}", -1)).otherwise(F.array().cast("array<string>"))
    whole = F.when(F.col("body").contains("\n"), F.array("body")).otherwise(F.array().cast("array<string>"))
    units = rows.select("k1", "k2", F.explode_outer(F.concat(lines, paragraphs, whole)).alias("unit"))
    units = once(units, words=words_of(F.col("unit"))).where(F.size("words") > shortest)
    units = once(units, a=bigrams(F.col("words"))).drop("words")
    sized = units.where((F.size("a") >= shortest) & (F.size("a") <= longest) & F.arrays_overlap("a", known))
    compared = []
    for r in listed:
        dice = 2 * F.size(F.array_intersect("a", hashes(r.b))) / (F.size("a") + len(r.b))
        bounded = F.size("a").between(len(r.b) * low, len(r.b) * high)
        compared.append(F.when(bounded, F.struct(dice.alias("dice"), F.lit(r.name).alias("name"))))
    best = F.array_sort(F.filter(F.array(*compared), lambda x: x.isNotNull() & (x["dice"] >= least)),
                        lambda x, y: F.when(x["dice"] != y["dice"], F.signum(y["dice"] - x["dice"]).cast("int"))
                        .when(x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).otherwise(0))
    hit = (once(sized, best=best).where(F.size("best") > 0)
           .select("k1", "k2", F.struct((-F.col("best")[0]["dice"]).alias("below"), F.col("best")[0]["name"].alias("name"), "unit").alias("x"))
           .groupBy("k1", "k2").agg(F.array_sort(F.collect_set("x")).alias("all")))
    licences = F.coalesce(F.transform("all", lambda x: F.struct(x["unit"].alias("unit"), x["name"].alias("name"), (-x["below"]).alias("dice"))),
                          F.array().cast("array<struct<unit:string,name:string,dice:double>>"))
    first = F.get("licences", F.lit(0))
    return (rows.select("doc_id", "k1", "k2").join(hit, ["k1", "k2"], "left")
            .select("doc_id", licences.alias("licences"))
            .select("doc_id", "licences", first["name"].alias("licence"), first["dice"].alias("dice")))
