import numpy as np
import pytest

from fableloom.llm.licences import TEMPLATES, TemplateIndex, scan_licences, words_of
from fableloom.llm.packing import default_tokenizer
from fableloom.llm.tokens import WordTokenizer
from fableloom.llm.token_scan import count_document_tokens, list_token_files, scan_token_files
from fableloom.llm.url_filter import build_cascade, build_cascades, judge_urls, shard_of


def grams(w):
    return set(zip(w, w[1:], strict=False))


def by_all_stretches(text):
    """Licence, coefficient, start and end of the best stretches that do not overlap, by comparing every stretch that begins and ends with bigrams of a template."""
    found, words = [], words_of(text)
    for name, own in TEMPLATES.items():
        for t in own:
            b, longest = grams(words_of(t)), 2 * len(words_of(t))
            at = [i for i in range(len(words) - 1) if (words[i], words[i + 1]) in b]
            for start in at:
                best = max(((2 * len(a & b) / (len(a) + len(b)), -end, len(a & b)) for end in at if start <= end < start + longest for a in [grams(words[start : end + 2])]), default=(0, 0, 0))
                if best[0] >= 0.8:
                    found.append((name, best[0], start, 2 - best[1], best[2]))
    kept = []
    for f in sorted(found, key=lambda f: (-f[4], -f[1], f[2], f[3], f[0])):
        if not any(f[2] < k[3] and k[2] < f[3] for k in kept):
            kept.append(f)
    return sorted(kept)


def full(name):
    return max(TEMPLATES[name], key=len)


def test_licences_against_all_stretches(docs, clashing):
    texts = [
        "Prose here.\nReleased under the MIT License.\nMore prose follows. Licensed under CC BY-NC 4.0.",
        full("ISC").replace(", ", ",\n"),
        "under the license",
        "Licensed under the Apache License, Version 2.0",
        "Before it, in the same line, " + full("MPL-2.0").replace("distributed", "given out") + " and after it.",
    ]
    frame = docs(*texts)
    for r in scan_licences(clashing(frame)).collect():
        if r.doc_id is None or r.doc_id >= len(texts):
            assert r.licences == "" and r.n_places == 0 and r.dice is None
            continue
        found = by_all_stretches(texts[r.doc_id])
        assert sorted(TemplateIndex().match(texts[r.doc_id])) == found
        assert r.licences == ",".join(sorted({f[0] for f in found})) and r.n_places == len(found) and (not found or r.dice == max(f[1] for f in found))
    assert scan_licences(docs().limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_wording_is_found_wherever_it_stands(name):
    index = TemplateIndex()
    for t in TEMPLATES[name]:
        words = t.split()
        paragraphs = "\n\n".join(" ".join(words[i : i + 30]) for i in range(0, len(words), 30))
        comment = "\n".join(" * " + " ".join(words[i : i + 8]) for i in range(0, len(words), 8))
        for text in (t, t.upper(), paragraphs, f"/*\n{comment}\n */\nint main;", f"A long line that goes on {t} and ends here."):
            assert max(index.match(text), key=lambda f: f[1])[1] >= 0.9 and name in {f[0] for f in index.match(text)}
        if len(words) > 60:  # words added and left out in a few places
            changed = [*words[:20], "really", *words[20:35], *words[37:]]
            assert name in {f[0] for f in index.match(" ".join(changed))}


def test_many_places_and_a_long_text():
    index = TemplateIndex()
    assert len(index.match("Some prose. Released under the MIT License. " * 300)) == 300
    assert index.match("word " * 500_000) == []
    assert index.match("licensed under the " * 200_000) == []  # bigrams of many templates, over and over
    again = index.match("licensed under the " * 20_000 + full("MIT") + " licensed under the" * 20_000)
    assert [f[0] for f in again] == ["MIT"]


@pytest.mark.parametrize("every", [8, 12, 25])
@pytest.mark.parametrize("mark", ["dnl", "REM"])
def test_a_word_before_every_line_hides_no_wording(mark, every):
    index = TemplateIndex()
    for name, own in TEMPLATES.items():
        for t in (t for t in own if len(words_of(t)) > 60):
            words = t.split()
            text = "\n".join(mark + " " + " ".join(words[i : i + every]) for i in range(0, len(words), every))
            found = grams(words_of(text))
            wanted = 2 * len(found & grams(words_of(t))) / (len(found) + len(grams(words_of(t))))
            if wanted >= 0.8:
                assert max(f[1] for f in index.match(text)) >= wanted - 1e-9
                assert every < 12 or name in {f[0] for f in index.match(text)}


def test_one_licence_for_one_place():
    index = TemplateIndex()
    assert {f[0] for f in index.match("It is under the GNU General Public License, version 3, as others are.")} <= {"GPL-3.0"}
    both = full("MIT") + "\n\n" + full("ISC")
    assert [f[0] for f in index.match(both)] == ["MIT", "ISC"]


@pytest.mark.parametrize("block_bytes", [1 << 22, 10])
def test_token_counts(docs, clashing, block_bytes):
    texts = ["one two three", "<|endoftext|> is text here", "", "x" * 400]
    frame = docs(*texts)
    encoder = WordTokenizer(default_tokenizer(), special_as_text=True)
    known = {r.doc_id: r.text for r in frame.collect()}
    rows = count_document_tokens(clashing(frame), block_bytes=block_bytes).collect()
    assert len(rows) == frame.count()
    assert all(r.n_tokens == len(encoder.encode([known[r.doc_id]])[0]) for r in rows)
    assert count_document_tokens(docs().limit(0)).count() == 0


@pytest.mark.parametrize("block", [2, 6, 64])
def test_scan_against_split(spark, tmp_path, block):
    r = np.random.default_rng(block)
    wanted = set()
    for k in range(4):
        ids = r.choice([7, 1, 2], size=[0, 1, 50, 301][k], p=[0.2, 0.4, 0.4]).astype("<u2")
        (tmp_path / f"{k}.tok").write_bytes(ids.tobytes() + b"z" * (k == 3))
        at = 0
        ends = [*np.flatnonzero(ids == 7).tolist(), *([len(ids)] if len(ids) and ids[-1] != 7 else [])]
        for n, e in enumerate(ends):
            wanted.add((f"{k}.tok", n, at, e - at))
            at = e + 1
    folder = f"file://{tmp_path}"
    found = scan_token_files(list_token_files(spark, folder), folder, separator=7, block_bytes=block).collect()
    assert {(x.file, x.document, x.start, x.n_tokens) for x in found} == wanted and len(found) == len(wanted)


def test_cascade_is_exact_and_has_levels(spark):
    from pyspark.sql import functions as F

    from fableloom.llm.common import materialise

    keys = materialise(spark.range(4000).select(F.concat(F.lit("host"), F.col("id").cast("string")).alias("key"), (F.col("id") % 7 == 0).alias("listed")), "test-keys")
    cascade = build_cascade(keys)
    assert len(cascade.levels) > 2
    assert keys.where(cascade.contains(F.col("key")) != F.col("listed")).count() == 0


def test_many_listed_hosts_are_dealt_to_several_cascades(spark):
    from pyspark.sql import functions as F

    from fableloom.llm.common import materialise

    keys = materialise(spark.range(60_000).select(F.concat(F.lit("host"), F.col("id").cast("string"), F.lit(".example")).alias("key"), (F.col("id") < 50_000).alias("listed")), "test-keys")
    cascades = build_cascades(keys, max_level_keys=30_000)
    assert len(cascades) == 2
    for i, c in enumerate(cascades):
        assert keys.where(shard_of(F.col("key"), 2) == i).where(c.contains(F.col("key")) != F.col("listed")).count() == 0
    pages = spark.range(0, 60_000, 7).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.host"), F.col("id").cast("string"), F.lit(".example/x")).alias("url"))
    found = judge_urls(pages, listed=keys.where("listed").select("key"), max_level_keys=4000)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where((F.col("verdict") == "block") != (F.col("page_id") < 50_000)).count() == 0 and found.count() == pages.count()


URLS = [
    ("http://A.Example.NET/en/x?y", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://b.net", "b.net", "", None, "allow"),
    ("https://b.net/", "b.net", "/", "net/", "block"),
    ("https://x.example.com/de/1#t", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("https://www.spam-farm.example.org/en", "www.spam-farm.example.org", "/en", None, "block"),
    ("https://free-bets.example.com/fr/", "free-bets.example.com", "/fr/", None, "block"),
    ("https://notspam-farm.example.org?x=/fr/", "notspam-farm.example.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


@pytest.mark.parametrize("most", [10_000_000, 1])
def test_urls(spark, clashing, most):
    own = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(None, None), (0, URLS[0][0])], "page_id long, url string")
    own = clashing(own).drop("key")
    found = judge_urls(own, max_level_keys=most).collect()
    wanted = [(str(i), *u[1:]) for i, u in enumerate(URLS)] + [("None", *URLS[-1][1:]), ("0", *URLS[0][1:])]
    assert sorted(str((str(r.page_id), r.host, r.path, r.rule, r.verdict)) for r in found) == sorted(map(str, wanted))
    assert judge_urls(own.limit(0)).count() == 0


def test_intermediates_need_a_shared_folder():
    """On a cluster a local warehouse is no place for them, nor is it taken where a folder is named."""
    from types import SimpleNamespace

    from fableloom.llm.common import shared_dir

    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))

    warehouse = {"spark.sql.warehouse.dir": "file:/here/warehouse/"}
    assert shared_dir(session("local[8]", **warehouse)) == "file:/here/warehouse/_intermediate"
    assert shared_dir(session("spark://host", **warehouse, **{"spark.checkpoint.dir": "hdfs:/c"})) == "hdfs:/c"
    assert shared_dir(session("yarn", **{"spark.sql.warehouse.dir": "hdfs:/w"})) == "hdfs:/w/_intermediate"
    for master in ("yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master, **warehouse))
