import re

from check_oracle import compare, connect
from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm import queries
from tillwork.llm.license_scan import TEMPLATES, Template, document_frequency, rare_positions, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    words, places, labels, score = words_of(text), [], set(), 0.0
    for t in TEMPLATES:
        key = list(t.words[t.key_from : t.key_to])
        for p in range(len(words) - len(key) + 1):
            if words[p : p + len(key)] == key:
                labels.add(t.label)
                start = p - t.key_from
                score = max(score, sum(0 <= start + q < len(words) and words[start + q] == w for q, w in enumerate(t.words)) / len(t.words))
                if t.base:
                    places.append((p, t.label))
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places)[0] if places else None, "last_word": max(places)[0] if places else None,
        "base_labels": ",".join(sorted({x for _, x in places})), "labels": ",".join(sorted(labels)), "score": score,
    }


TEXTS = [
    None, "", "under the mit", "Released under the MIT License.", "under the mit license under the mit license", "Apache License, Version 2.0", "apache license version 20",
    "CC BY-NC 4.0 and cc by nc", "ccby nc", "cc", "x " * 50000 + "cc by nc", "été cc by ncé", "under the mit licenseé", "under\nthe-MIT/license", "GNU General Public License, version 3",
    "This work is licensed under the GNU General Public License, version 2", "mit license", "the mit license", "version 2.0. the license", "\U0001f600cc by nc", "cc by cc by nc",
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, label string, score int").repartition(3)
    for row in plain(scan_licenses(docs)):
        want = brute(TEXTS[row["doc_id"]])
        assert {k: row[k] for k in want} == want
        assert len([s for s in row["spans"]]) >= row["n_base"]


def test_rare_words_follow_all_documents(spark):
    docs = spark.createDataFrame([("mit the",), ("the license",), ("the license",), (None,)], "text string")
    frequency, rows = document_frequency(docs, TEMPLATES)
    assert rows == 4 and (frequency["the"], frequency["license"], frequency["mit"], frequency["under"]) == (3, 2, 1, 0)
    assert rare_positions(Template.of("mit", "", "under the mit license"), frequency, rows) == [0, 2]


def test_hard_rows(spark, documents):
    rows = plain(scan_licenses(documents))
    assert len(rows) == documents.count() and {r["labels"] for r in rows} == {""}
    assert scan_licenses(documents.limit(0)).count() == 0


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op1", queries.QUERIES["op1_license_scan"], queries.ORACLES["op1_license_scan"])[0] == "same"
