import random

from helpers import documents, lower, plain

from dayshape.llm.license_scan import CONTAINMENT, PHRASES, TEMPLATES, license_scan


def brute(text):
    words = plain(text)
    places = [
        (label, i)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    shares = {}
    for line in lower(text).split("\n"):
        for label, notice in TEMPLATES.items():
            t = set(notice.split())
            share = len(t & set(plain(line))) / len(t)
            if share >= CONTAINMENT:
                shares[label] = max(share, shares.get(label, 0))
    own = {label for label, _ in places}
    at = [i for _, i in places]
    score = 1.0 if at else max(shares.values(), default=0.0)
    joined = [",".join(sorted(x)) for x in (own, own | set(shares))]
    return (len(words), len(at), min(at, default=None), max(at, default=None), *joined, score)


def texts():
    rnd = random.Random(2)
    pool = sorted({w for t in TEMPLATES.values() for w in t.split()}) + ["x", "y"]
    out = [None, "", "\n\n", "MIT-License, GNU general\npublic license! CC.BY cc by", "mit\x00license", "K cc by İ", "cc"]
    for text in TEMPLATES.values():
        words = text.split()
        for drop in range(4):
            kept = rnd.sample(words, max(1, len(words) - drop))
            out.append("before it\n" + " ".join(kept).upper() + ".\nafter " + " ".join(rnd.choices(pool, k=5)))
    out += [" ".join(rnd.choices(pool, k=60)) for _ in range(20)]
    return out + ["apache license " * 3000]


def test_same_as_brute_force(spark, rows):
    every = texts()
    got = rows(license_scan(documents(spark, every, row="a", places="b", word="c")))
    assert got == sorted([(i, *brute(t)) for i, t in enumerate(every)], key=repr)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame(
        [(1, "released under the MIT license"), (1, "x"), (1, "x"), (None, "licensed under cc by nc 4.0"), (None, None)],
        "doc_id long, text string",
    )
    got = sorted((repr(r.doc_id), r.labels) for r in license_scan(docs).collect())
    assert got == [("1", ""), ("1", ""), ("1", "mit,mit-notice"), ("None", ""), ("None", "cc-by,cc-by-notice")]
    assert license_scan(docs.limit(0)).count() == 0
