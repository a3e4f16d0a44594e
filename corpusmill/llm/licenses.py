"""Licence recognition by sentences and ordered rules (operator 8).

Built-in functions only. A text is cut into sentences (after ``. ! ? ;`` and
white space, and before a line that does not go on in lower case), each is
normalised (a-z, digits and dots; everything else is one space) and looked up
among the known licence sentences. The identifiers found, in text order, form
a sequence; the ordered rules are matched against it one after the other, a
rule's identifiers have to follow each other, and what a rule has matched is
taken out before the next. Texts without any of the ``ANCHORS`` are not cut
up, since every known sentence holds one of them.

Defined results: a null or empty text, or one without a known sentence, has 0
sentences, an empty sequence, no licence and status ``none``; known sentences
that no rule matches give ``unmatched``. Rows repeat as in the input, a null
doc_id is kept, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Single words only: no white space or mark that normalising takes out can part them.
ANCHORS = ("licen[cs]e", "reserved", "permission", "warranty", "redistribut", "copyright", "domain",
           "provided", "neither")

#: normalised sentence -> identifier
SENTENCES = {
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "this project is licensed under the mit license": "MitRef",
    "spdx license identifier mit": "MitRef",
    "licensed under the apache license version 2.0": "ApacheRef2",
    "licensed under the apache license version 2.0 the license": "ApacheRef2",
    "released under the apache license version 2.0": "ApacheRef2",
    "spdx license identifier apache 2.0": "ApacheRef2",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "ApacheCopy",
    "this work is licensed under the gnu general public license version 3": "GplRef3",
    "this program is licensed under the gnu general public license version 3": "GplRef3",
    "spdx license identifier gpl 3.0 only": "GplRef3",
    "this work is licensed under the gnu general public license version 2": "GplRef2",
    "spdx license identifier gpl 2.0 only": "GplRef2",
    "you should have received a copy of the gnu general public license along with this program": "GplCopy",
    "licensed under cc by 4.0": "CcBy4",
    "licensed under cc by sa 4.0": "CcBySa4",
    "licensed under cc by nc 4.0": "CcByNc4",
    "this work is licensed under a creative commons attribution 4.0 international license": "CcBy4",
    "released under the bsd 3 clause license": "Bsd3Ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided"
    " that the following conditions are met": "BsdGrant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied": "NoWarranty",
    "this work is in the public domain": "PublicDomain",
    "all rights reserved": "AllRights",
}

#: Sentences of whole licence texts: (the words that have to be there, the rest, identifier). A line that does not go
#: on in lower case, as of upper-case or commented text, cuts a sentence at any word of the rest.
WHOLE = [
    ("permission is hereby granted free of charge",
     "to any person obtaining a copy of this software and associated documentation files the software to deal in the"
     " software without restriction including without limitation the rights to use copy modify merge publish distribute"
     " sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
     " subject to the following conditions", "MitGrant"),
    ("the above copyright notice and this permission notice shall",
     "be included in all copies or substantial portions of the software", "MitNotice"),
    ("the software is provided as is",
     "without warranty of any kind express or implied including but not limited to the warranties of merchantability"
     " fitness for a particular purpose and noninfringement", "NoWarranty"),
    ("redistribution and use in source and binary forms",
     "with or without modification are permitted provided that the following conditions are met", "BsdGrant"),
    ("neither the name of the copyright holder nor",
     "the names of its contributors may be used to endorse or promote products derived from this software without"
     " specific prior written permission", "BsdNames"),
    ("this software is provided by the copyright holders and",
     "contributors as is and any express or implied warranties including but not limited to the implied warranties of"
     " merchantability and fitness for a particular purpose are disclaimed", "BsdAsIs"),
    ("permission to use copy modify and or distribute this software",
     "for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission"
     " notice appear in all copies", "IscGrant"),
    ("the software is provided as is and the author",
     "disclaims all warranties with regard to this software including all implied warranties of merchantability and"
     " fitness", "IscAsIs"),
]
for _head, _rest, _id in WHOLE:
    _words = _rest.split()
    SENTENCES.update({" ".join([_head, *_words[:k]]): _id for k in range(len(_words) + 1)})

#: licence -> identifiers in order; the first rule that fits takes them
RULES = [
    ("BSD-3-Clause", "AllRights BsdGrant BsdNames BsdAsIs"),
    ("BSD-3-Clause", "BsdGrant BsdNames BsdAsIs"),
    ("BSD-2-Clause", "AllRights BsdGrant BsdAsIs"),
    ("BSD-2-Clause", "BsdGrant BsdAsIs"),
    ("ISC", "IscGrant IscAsIs"),
    ("ISC", "IscGrant NoWarranty"),
    ("MIT", "MitGrant MitNotice NoWarranty"),
    ("MIT", "MitGrant MitNotice"),
    ("MIT", "MitRef"),
    ("Apache-2.0", "ApacheRef2 ApacheComply ApacheCopy"),
    ("Apache-2.0", "ApacheRef2"),
    ("GPL-3.0", "GplRef3 GplCopy"),
    ("GPL-3.0", "GplRef3"),
    ("GPL-2.0", "GplRef2 GplCopy"),
    ("GPL-2.0", "GplRef2"),
    ("CC-BY-NC-4.0", "CcByNc4"),
    ("CC-BY-SA-4.0", "CcBySa4"),
    ("CC-BY-4.0", "CcBy4"),
    ("BSD-3-Clause", "BsdGrant NoWarranty"),
    ("BSD-3-Clause", "Bsd3Ref"),
    ("Public-Domain", "PublicDomain"),
    ("Proprietary", "AllRights"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    marked = F.regexp_replace(text, r"([.!?;])[ \t\r\n]", "$1\u0001")
    marked = F.regexp_replace(marked, r"\n([^a-z])", "\u0001$1")
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    parts = F.transform(F.split(F.translate(marked, _UPPER, _LOWER), "\u0001"),
                        lambda x: F.trim(F.regexp_replace(x, "[^a-z0-9.]+", " "), F.lit(" .")))
    ids = F.filter(F.transform(parts, lambda x: F.try_element_at(known, x)), lambda x: x.isNotNull())
    anchored = F.translate(text, _UPPER, _LOWER).rlike("|".join(ANCHORS))
    return F.when(anchored, ids).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentence_ids, licenses, status per row."""
    ids = docs.select("doc_id", sentence_ids(F.col("text")).alias("ids"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f" {seq} ").alias("seq")) for name, seq in RULES])
    # every identifier stands between spaces of its own, so a rule's text is found only as whole identifiers
    start = F.struct(F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" ")).alias("rest"),
                     F.array().cast("array<string>").alias("found"))

    def apply(state, rule):
        wanted = F.replace(rule["seq"], F.lit(" "), F.lit("  "))
        wanted = F.substring(wanted, F.lit(2), F.length(wanted) - 2)
        return F.when(F.contains(state["rest"], wanted), F.struct(
            F.replace(state["rest"], wanted, F.lit(" | ")).alias("rest"),
            F.array_union(state["found"], F.array(rule["name"])).alias("found"))).otherwise(state)

    out = ids.withColumn("state", F.aggregate(rules, start, apply))
    return out.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce(F.array_join("ids", " "), F.lit("")).alias("sentence_ids"),
        F.coalesce(F.array_join("state.found", ","), F.lit("")).alias("licenses"),
        F.when(F.coalesce(F.size("ids"), F.lit(0)) <= 0, "none")
         .when(F.size("state.found") > 0, "known").otherwise("unmatched").alias("status"))


def scan_sql() -> str:
    """The same as DuckDB SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in SENTENCES.items())
    sql = f"""
with known(sentence, id) as (values {known}),
parts as (
  select rowid_ as r, unnest(string_split(translate(regexp_replace(regexp_replace(text, '([.!?;])[ \\t\\r\\n]', '\\1' || chr(1), 'g'),
         '\\n([^a-z])', chr(1) || '\\1', 'g'), '{_UPPER}', '{_LOWER}'), chr(1))) as s,
         generate_subscripts(string_split(translate(regexp_replace(regexp_replace(text, '([.!?;])[ \\t\\r\\n]', '\\1' || chr(1), 'g'),
         '\\n([^a-z])', chr(1) || '\\1', 'g'), '{_UPPER}', '{_LOWER}'), chr(1)), 1) as i
  from (select row_number() over () as rowid_, text from documents) where text is not null),
found as (
  select r, i, id from (select r, i, trim(regexp_replace(s, '[^a-z0-9.]+', ' ', 'g'), ' .') as sentence from parts)
  join known using (sentence)),
seqs as (select r, count(*) as n, string_agg(id, ' ' order by i) as ids, ' ' || string_agg(id, '  ' order by i) || ' ' as rest
         from found group by r),
step0 as (select *, []::varchar[] as got from seqs)"""
    for k, (name, seq) in enumerate(RULES):
        wanted = quote(" " + seq.replace(" ", "  ") + " ")
        sql += f""",
step{k + 1} as (select r, n, ids,
  case when contains(rest, {wanted}) then replace(rest, {wanted}, ' | ') else rest end as rest,
  case when contains(rest, {wanted}) and not list_contains(got, '{name}') then list_append(got, '{name}') else got end as got
  from step{k})"""
    return sql + f"""
select d.doc_id, coalesce(n, 0)::bigint as n_sentences, coalesce(ids, '') as sentence_ids,
       coalesce(array_to_string(got, ','), '') as licenses,
       case when n is null then 'none' when len(got) > 0 then 'known' else 'unmatched' end as status
from (select row_number() over () as r, doc_id from documents) d left join step{len(RULES)} using (r)"""
