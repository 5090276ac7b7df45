import hashlib
import random

from helpers import documents, plain, words

from dayshape.llm.decontaminate import clean, hits, longest_matches, summary


def brute(texts, items, window):
    out = []
    for doc, text in enumerate(texts):
        own, hit, found = plain(text), set(), set()
        for name, item in items:
            test = plain(item)
            size = min(window, len(test))
            for a in range(len(test) - size + 1 if test else 0):
                for at in range(len(own) - size + 1):
                    if own[at : at + size] == test[a : a + size]:
                        hit |= set(range(at, at + size))
                        found.add(str(name))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def tables(seed):
    rnd = random.Random(seed)
    items = [(k, " ".join(words(rnd, rnd.choice([0, 1, 4, 12, 30]), "abc", 2))) for k in range(25)] + [(25, None), (9, "Ä-b C")]
    texts = []
    for _ in range(80):
        parts = words(rnd, rnd.randrange(40), "abc", 2)
        item = (rnd.choice(items)[1] or "").split()
        cut = rnd.randrange(len(item) + 1)
        texts.append(" ".join(parts) + "\n" + ", ".join(item[cut:]).upper() + " " + " ".join(parts))
    return [*texts, None, "", "ä b\tc", "x" * 4000, " ".join(words(rnd, 3000, "abc", 2))], items


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_same_as_brute_force(spark, rows):
    texts, items = tables(1)
    docs = documents(spark, texts, items="x", starts="y")
    assert rows(summary(hits(docs, benchmark(spark, items), 5))) == brute(texts, items, 5)


def test_benchmark_in_several_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr("dayshape.llm.decontaminate.BLOCK_CHARS", 200)
    texts, items = tables(2)
    assert rows(summary(hits(documents(spark, texts), benchmark(spark, items), 5))) == brute(texts, items, 5)


def test_affected_rows_go_and_columns_stay(spark):
    texts, items = tables(3)
    docs = documents(spark, texts).unionByName(
        spark.createDataFrame([(None, items[-1][1])], "doc_id long, text string"), allowMissingColumns=True
    )
    kept = clean(docs, benchmark(spark, items), 5)
    assert kept.columns == docs.columns
    wanted = {r[0] for r in brute(texts, items, 5) if not r[5]} | {None}
    assert {r.doc_id for r in kept.collect()} == wanted


def test_empty_tables(spark):
    texts, items = tables(4)
    assert hits(documents(spark, texts).limit(0), benchmark(spark, items)).count() == 0
    assert clean(documents(spark, texts), benchmark(spark, items).limit(0)).count() == len(texts)


def test_longest_matches_are_longest_and_stand_there(spark):
    texts, items = tables(5)
    items = items[:25]
    found = {(r.item_id, r.item_start): r for r in longest_matches(documents(spark, texts), benchmark(spark, items), 3).collect()}
    split = [plain(t) for t in texts]
    for name, item in items:
        test = plain(item)
        for start in range(len(test)):
            best = 0
            for own in split:
                for at in range(len(own)):
                    size = 0
                    while size < min(len(test) - start, len(own) - at) and own[at + size] == test[start + size]:
                        size += 1
                    best = max(best, size)
            r = found.get((str(name), start))
            assert (r.n_matched if r else 0) == (best if best >= 3 else 0)
            if r:
                assert split[r.doc_id][r.doc_start : r.doc_start + best] == test[start : start + best]
