import random
import re

from tandem.llm.licenses import COVERAGE, PAIR, PHRASES, SLACK, TEMPLATES, Template, license_spans
from tandem.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def places(text):
    found = words(text)
    return sorted((i, label) for label, phrase in PHRASES for i in range(len(found))
                  if found[i: i + len(phrase.split())] == phrase.split())


def exact(row):
    return sorted((span.first_word, span.label) for span in row.spans if span.exact)


def test_phrases_wherever_they_stand(spark):
    rng = random.Random(4)
    few = ["cc", "by", "all", "rights", "reserved", "General", "public", "license", "x", "é", "CC-BY", "ALL"]
    rows = [(i, " ".join(rng.choices(few, k=rng.choice([0, 1, 2, 3, 30, 300]))), "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "cc by", "x"), (101, "cc by", "x"), (None, "cc by", "x"), (None, None, "x"),
             (102, "ccby c c b y", "x"), (101, "all rights", "x"), (103, "cc by " * 5000, "x")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    found = license_spans(documents).collect()
    assert sorted((str(r.doc_id), r.n_words, exact(r)) for r in found) == sorted(
        (str(i), len(words(text)), places(text)) for i, text, _ in rows)
    assert license_spans(documents.limit(0)).count() == 0


def test_notices_with_edits(spark):
    notice = next(t.text for t in TEMPLATES if t.label == "mit" and len(t.text) > 100)
    parts = notice.split()
    missing = " ".join(parts[:10] + parts[11:])
    added = " ".join(parts[:14] + ["really"] + parts[14:])
    rows = [(1, f"Some code. {notice} More."), (2, f"intro words {missing}"), (3, added), (4, " ".join(parts[:9])),
            (5, " ".join(reversed(parts))), (6, "Licensed under CC BY-NC 4.0."), (7, f"{notice} gap {notice}")]
    found = {r.doc_id: r.spans for r in license_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [span.label for span in found[1]] == ["mit"] and found[1][0].first_word == 2 and found[1][0].coverage == 1.0
    assert [span.label for span in found[2]] == ["mit"] and found[2][0].coverage < 1
    assert [span.label for span in found[3]] == ["mit"]
    assert found[4] == [] and found[5] == []
    assert sorted(span.label for span in found[6]) == ["cc-by", "cc-by-nc"]
    assert [span.label for span in found[7]] == ["mit", "mit"]


def plain_spans(text):
    """Diagonal voting by words and lists, without hashes: (first, last, label, exact, coverage) of every span."""
    found, spans = words(text), []
    for template in TEMPLATES:
        own = words(template.text)
        pairs = [tuple(own[i: i + PAIR]) for i in range(len(own) - PAIR + 1)]
        votes = sorted((i - place, place, i) for place, pair in enumerate(pairs)
                       for i in range(len(found) - PAIR + 1) if tuple(found[i: i + PAIR]) == pair)
        bands = []
        for vote in votes:
            if not bands or vote[0] - bands[-1][-1][0] > (0 if template.exact else SLACK):
                bands.append([])
            bands[-1].append(vote)
        for band in bands:
            seen, matched = {place for _, place, _ in band}, {i for _, _, i in band}
            first, last = min(matched), max(matched)
            share = len(seen) / len(pairs)
            enough = len(seen) == len(pairs) if template.exact else min(share, len(matched) / (last - first + 1)) >= COVERAGE
            if enough:
                spans.append((first, last + 1, template.label, template.exact, share))
    return sorted(spans)


def edited(rng, text):
    parts = text.split()
    for _ in range(rng.choice([0, 0, 1, 2, 6])):
        at = rng.randrange(len(parts))
        parts[at: at + rng.choice([0, 1])] = rng.choices(["really", "by", "license", "the"], k=rng.choice([0, 1, 2]))
    return " ".join(parts)


def test_all_spans_against_plain_voting(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        parts = [edited(rng, rng.choice(TEMPLATES).text) if rng.random() < 0.7 else "plain words of a text"
                 for _ in range(rng.randint(0, 5))]
        rows.append((i, " and ".join(parts)))
    found = {r.doc_id: r.spans for r in license_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, text in rows:
        assert sorted(tuple(span) for span in found[i]) == plain_spans(text)
    assert sum(not span.exact for spans in found.values() for span in spans) > 20


def test_own_templates(spark):
    documents = spark.createDataFrame([(1, "to be or not to be")], "doc_id int, text string")
    found = license_spans(documents, templates=[Template("b", "to be", True)]).collect()[0]
    assert [(span.first_word, span.last_word) for span in found.spans] == [(0, 1), (4, 5)]


def test_query_against_a_plain_search(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op9_license_scan"](spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        found = places(text)
        labels = sorted({label for _, label in found})
        row = rows[i]
        assert (row.n_words, row.n_base, row.base_labels) == (len(words(text)), len(found), ",".join(labels))
        assert (row.first_word, row.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        spans = plain_spans(text)
        assert row.labels == ",".join(sorted({label for _, _, label, _, _ in spans}))
        assert row.score == max((share for *_, share in spans), default=0.0)
