"""Language filters, quality, tokenizers, counts, packing, licences."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import importance, langid, licenses, packing, piece_bpe, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score double, n long"
TEXTS = [None, "", " ", "a", "  two  spaces\n\nlines \t tab", "It's <|endoftext|> here, isn't it?", "<s> ▁▁ </s> <0x0A>",
         "Müller grüßt 日本語 🙂 é ﬁ İ", "x" * 3000, " " * 70, "\n\n\n", "word " * 1500, "A.B,c;d!!! 12 345",
         "a b\x1cc\x85d", "end \n", "ending.\n\nNext  one", "▁ odd", "été"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 0.5, 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id", None, None, None, None, None)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _sha(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_piece_bpe_equals_library(docs, empty):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = piece_bpe.encode_decode(docs, P.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        ids = lib.encode("no id" if r.doc_id is None else TEXTS[r.doc_id] or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), _sha(ids))
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert piece_bpe.encode_decode(empty, P.path("piece_bpe_32k.model")).count() == 0


def test_piece_bpe_random_words():
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_bpe.PieceBpe(path)
    rng = random.Random(5)
    pieces = list(own.ids)
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))).replace("▁", " ")
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == lib.encode(text), text
        assert own.decode(np.array([1, *ids, 2], "<u4").tobytes()) == lib.decode(ids)
    broken = [3 + 0xC3, 3 + 0x28, 300, 3 + 0xF0, 3 + 0x9F]
    assert own.decode(np.array(broken, "<u4").tobytes()) == lib.decode(broken)


def test_prefix_table_holds_each_prefix_encoding():
    own = piece_bpe.PieceBpe(P.path("piece_bpe_32k.model"))
    word = "▁unbelievable"
    last = own.table(word)
    for n in range(1, len(word) + 1):
        assert own.text[last[n]] == own.merge(word[:n])[-1]


def test_token_counts_equal_library(docs, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = token_counts.count_tokens(docs, P.path("word_bpe_49k.json"), limit=1000).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(lib.encode(text, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1000)
    assert token_counts.count_tokens(empty, P.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (200, 40), (50, 4)])
def test_resynchronised_counts(chunk, overlap):
    counter = token_counts.Counter(P.path("word_bpe_49k.json"))
    rng = random.Random(chunk)
    for _ in range(40):
        text = " ".join("".join(rng.choice("abcé.,<|>12'") for _ in range(rng.choice([1, 3, 9, 90])))
                        for _ in range(60)) + "<|endoftext|> x"
        assert counter.long(text, chunk, overlap) == len(counter.library.encode(text, add_special_tokens=False))
    alone = "q" * 1000  # no white space to splice at: widened to the whole
    assert counter.long(alone, chunk, overlap) == len(counter.library.encode(alone, add_special_tokens=False))


def test_words_of_letters_are_encoded_without_looking_for_parts(monkeypatch):
    from tokenizers import Tokenizer

    from corpusmill.llm import byte_bpe
    path = P.path("byte_bpe_50k.json")
    lib, mine = Tokenizer.from_file(path), byte_bpe.ByteBpe(path)
    monkeypatch.setattr(byte_bpe, "_PLAIN", None)
    for text in ("word", "Thhaen anblewh sttible", "Éaux émentrèlle SSÜ straße", "a b c"):
        assert mine.encode(text) == np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_places_every_token(docs, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packing.pack(docs, P.path("byte_bpe_50k.json"), capacity=64).toPandas()
    total = 0
    for i, text in [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id")]:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i].drop_duplicates("piece")
        mine = mine.sort_values("piece")
        assert mine.length.sum() == len(ids) and (mine.length[1:] == 64).all()
        for r in mine.itertuples():
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
    assert got.length.sum() == total
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    sums = got.groupby("sequence_id").length.sum()
    assert sums.max() <= 64 and len(sums) <= -(-total // 64) + 1
    assert packing.pack(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_fullest_combination_against_all_subsets():
    from itertools import product
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(0, 40)
        best = max(s for n in product(*(range(c + 1) for c in counts.values()))
                   if (s := sum(a * b for a, b in zip(n, counts))) <= room)
        chosen = packing.fullest(counts, room)
        assert sum(k * v for k, v in chosen.items()) == best
        assert all(v <= counts[k] for k, v in chosen.items())


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_filter_answers_every_language_at_once():
    grams = {"a": np.arange(1, 500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15),
             "b": np.arange(400, 900, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)}
    model = langid.build_filter(["a", "b"], grams)
    for k, name in enumerate(["a", "b"]):
        found = None
        for p in model.positions(grams[name]):
            found = model.masks[p] if found is None else found & model.masks[p]
        assert ((found[:, 0] >> k) & 1).all()


def test_language_edge_cases(spark, docs, empty):
    rows = {r.doc_id: r for r in langid.predict(docs, None, ["doc_id"]).collect()}
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows.values())
    got = langid.identify(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.lang_pred == "und") == (not text or not any(c.isalpha() for c in text))
    assert langid.identify(empty).count() == 0


def test_copies_do_not_shrink_the_language_sample(spark):
    rng = random.Random(4)
    rows = [(" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(20)), "xx") for _ in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    copies = spark.range(5000).select(F.lit(rows[0][0]).alias("text"), F.lit("xx").alias("lang"))
    plain, skewed = (langid.train(d, train_docs=200) for d in (docs, docs.unionByName(copies)))
    assert plain.masks.any() and np.array_equal(plain.masks, skewed.masks)


def _brute_weights(rows, good, buckets):
    """Counts and log ratios with plain dictionaries over the same features."""
    raw, target, per = {}, {}, {}
    for i, text in rows:
        data = (text or "").encode()
        b, _ = importance.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        per[i] = b.tolist()
        for x in per[i]:
            raw[x] = raw.get(x, 0) + 1
            if i in good:
                target[x] = target.get(x, 0) + 1
    n, m = sum(raw.values()) + buckets, sum(target.values()) + buckets
    return {i: sum(np.log((target.get(x, 0) + 1) / m / ((raw[x] + 1) / n)) for x in b) if b else None
            for i, b in per.items()}


def test_importance_weights_against_brute_force(spark, docs):
    labels = spark.createDataFrame([(3, 1, 0), (11, 1, 0), (5, 1, 0), (14, 1, 0), (12, 0, 1), (99, 1, 0), (None, 1, 1), (4, None, 0)],
                                   "doc_id long, quality int, toxic int")
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in importance.draw(plain, labels, k=5).collect()}
    fitted = {r.doc_id for r in importance.labelled(labels).where("fit and good = 1").collect()}
    want = _brute_weights(list(enumerate(TEXTS)), fitted, importance.BUCKETS)
    for i, w in want.items():
        assert (got[i].log_weight is None) == (w is None)
        assert w is None or got[i].log_weight == pytest.approx(w)
    keys = sorted((r.gumbel_key for r in got.values() if r.gumbel_key is not None), reverse=True)
    assert {r.doc_id for r in got.values() if r.selected} == {
        r.doc_id for r in got.values() if r.gumbel_key is not None and r.gumbel_key >= keys[4]}


def test_importance_edge_cases(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = importance.draw(docs, labels).collect()
    assert len(got) == len(TEXTS) + 2
    assert all((r.log_weight in (None, 0.0)) and r.selected == (r.log_weight is not None) for r in got)
    assert importance.draw(empty, labels).count() == 0
    kept = importance.drawn(docs, labels)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0


def test_threshold_is_the_kth_largest(spark):
    values = [random.Random(2).gauss(0, 1e3) for _ in range(500)] + [5.0] * 50 + [None]
    keys = spark.createDataFrame([(v,) for v in values], "v double")
    order = sorted((v for v in values if v is not None), reverse=True)
    for k in (1, 7, 250, 549):
        assert importance.threshold(keys, "v", k) == order[k - 1]
    assert importance.threshold(keys, "v", 600) == -np.inf


def test_quality_separates_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    learnt, rest = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = importance.draw(docs, learnt).join(rest, "doc_id").groupBy("quality").agg(
        F.avg(F.col("selected").cast("int")).alias("share")).collect()
    share = {r.quality: r.share for r in got}
    assert share[1] > 0.98 and share[0] < 0.2


def test_license_rules(spark, empty):
    cases = [
        (1, "Released under the MIT License.\nText goes on.", "MitRef", "MIT", "known"),
        (2, "Licensed under the Apache License, Version 2.0. All rights reserved.", "ApacheRef2 AllRights",
         "Apache-2.0,Proprietary", "known"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\n"
            "associated documentation files (the \"Software\"), to deal in the Software without restriction.\n"
            "The above copyright notice and this permission notice shall be included in all copies or\n"
            "substantial portions of the Software.", "MitGrant MitNotice", "MIT", "known"),
        (4, "You may not use this file except in compliance with the License.", "ApacheComply", "", "unmatched"),
        (5, "nothing here about it", "", "", "none"),
        (6, None, "", "", "none"),
        (7, "", "", "", "none"),
        (8, "MIT License all rights reserved maybe", "", "", "none"),
        (9, "spdx-license-identifier: MIT", "MitRef", "MIT", "known"),
        (10, "Released under the MIT License. Released under the MIT License.", "MitRef MitRef", "MIT", "known"),
    ]
    docs = spark.createDataFrame([(c[0], c[1], "x") for c in cases], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, _, ids, found, status in cases:
        assert (got[i].sentence_ids, got[i].licenses, got[i].status) == (ids, found, status), i
        assert got[i].n_sentences == len(ids.split())
    assert licenses.scan(empty).count() == 0


def _scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    return [(r.sentence_ids, r.licenses, r.status) for r in licenses.scan(docs).orderBy("doc_id").collect()]


def test_license_anchors_ignore_white_space_and_marks(spark):
    texts = ["All rights\nreserved.", "All  rights  reserved", "This work is in the public\ndomain.", "This work is in the public-domain."]
    assert [g[:2] for g in _scanned(spark, texts)] == [("AllRights", "Proprietary")] * 2 + [("PublicDomain", "Public-Domain")] * 2


MIT_TEXT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD_HEAD = """Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice.
"""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.
"""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.
"""


def test_whole_license_texts_wrapped_unwrapped_and_commented(spark):
    whole = {"MIT": MIT_TEXT, "BSD-2-Clause": BSD_HEAD + BSD_AS_IS, "BSD-3-Clause": BSD_HEAD + BSD_NAMES + BSD_AS_IS, "ISC": ISC_TEXT}
    forms = [lambda t: t, lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
             lambda t: "\n".join(" * " + line for line in t.split("\n"))]
    got = _scanned(spark, [form(t) for form in forms for t in whole.values()])
    assert [g[1:] for g in got] == [(name, "known") for _ in forms for name in whole]


def test_license_sentences_hold_an_anchor_and_are_normal():
    import re
    for sentence in licenses.SENTENCES:
        assert re.search("|".join(licenses.ANCHORS), sentence), sentence
        assert re.fullmatch("[a-z0-9.]+( [a-z0-9.]+)*", sentence)
    assert {i for _, s in licenses.RULES for i in s.split()} <= set(licenses.SENTENCES.values())


def test_license_scan_is_native(spark, docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
