import re

from pyspark.sql import functions as F

from lakeproof.llm import license_scan as ls
from lakeproof.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


MADE = [None, "", "MIT License", "mit-license MIT  LICENSE, x Apache License!", "the general public licensee",
        "GNU General Public License; mit license mit license", "mit license mit", "license mit apache mit license",
        "General\nPublic\tLicense", "\xe9mit license", "9mit license", "x" * 1000 + " apache license",
        " ".join(["the"] * 5000) + " released under the MIT license " + " ".join(["the"] * 5000)]


def test_base_equals_brute_force(spark, few):
    rows = [(i, t) for i, t in enumerate(MADE + [t for _, t in few])]
    got = {r.doc_id: r for r in ls.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_templates_label_their_own_texts(spark):
    rows = [(i, "Some file.\n" + body.title() + ".\nAnd more.") for i, (_, _, body) in enumerate(ls.TEMPLATES)]
    got = {r.doc_id: r for r in ls.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, key, _) in enumerate(ls.TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score >= 0.99
        assert any(p.label == label for p in got[i].places)
        # Without its mandatory phrase a text has no label of the template.
    rows = [(0, "redistribution and reuse in source and binary forms with or without modification are permitted")]
    assert ls.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).first().labels == ""


def test_postings_must_meet_at_one_place():
    """With the key phrase in place and most words about it, a label still needs agreeing hits."""
    number, t = next((i, t) for i, t in enumerate(ls.templates()) if t.label == "bsd")
    index = ls.Index({b"": 1000, **dict.fromkeys(t.key, 900)})      # the rare words stand outside the key phrase
    indexed = {at for w, found in index.postings.items() for n, at in found if n == number}
    key = range(t.key_at, t.key_at + len(t.key))
    outside = indexed - set(key)
    assert len(outside) >= 2 and len(indexed) - len(outside) < index.needed[number]
    words = [w.decode() if i not in outside else f"other{i}" for i, w in enumerate(t.words)]
    assert index._coverage([w.encode() for w in words], t, 0) >= ls.MIN_SCORE
    assert index.scan(" ".join(words))[5] == ""
    # One word more or less in between is drift; the hits still meet.
    at = max(key) + 1
    moved = [w.decode() for w in t.words]
    moved[at:at] = ["also"]
    assert index.scan(" ".join(moved))[5] == "bsd"
    # The same hits far from each other do not.
    apart = [w.decode() for w in t.words]
    apart[at:at] = ["far"] * 50
    assert index.scan(" ".join(apart))[5] == ""


def test_query(spark, sf, few):
    got = {r.doc_id: r for r in QUERIES["op8_license_scan"](spark, sf).collect()}
    assert all((got[d].n_words, got[d].n_base, got[d].first_word, got[d].last_word, got[d].base_labels) == brute(t)
               for d, t in few)


def test_edges(edge):
    got = ls.scan_licenses(edge)
    assert got.count() == edge.count()
    assert got.where("n_words = 0 and (labels <> '' or score <> 0)").count() == 0
    assert ls.scan_licenses(edge.where(F.lit(False))).count() == 0
