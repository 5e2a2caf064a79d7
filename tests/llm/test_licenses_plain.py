"""The query of licence scans, held to plain cosines of every line and every block and a plain walk up the directories."""

import math
import re
from collections import Counter

import pytest
from ledgerwright.llm import licenses, queries


class Plain:
    def __init__(self, texts):
        known = {t for _, text, *_ in licenses.listed() for t in licenses.terms(text)}
        held = Counter(t for x in texts if x is not None for t in set(licenses.terms(x)) & known)
        self.idf = {t: math.log((1 + len(texts)) / (1 + held[t])) + 1 for t in known}
        self.rest = math.log(1 + len(texts)) + 1
        self.lines = [(name, self.vector(licenses.terms(n))) for name, all_ in licenses.TEMPLATES.items() for n in all_]
        self.blocks = [(name, self.vector(licenses.terms(n)), len(licenses.terms(n)), needed, begins) for name, n, needed, begins in licenses.listed()]

    def vector(self, words):
        return {t: n * self.idf.get(t, self.rest) for t, n in Counter(words).items()}

    def cosine(self, words, template):
        v = self.vector(words)
        dot = sum(x * template.get(t, 0.0) for t, x in v.items())
        return dot / math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in template.values())) if dot else 0.0

    def licence(self, text):
        """(licence, cosine) of the nearest line or block at the threshold or above."""
        if text is None:
            return None, 0.0
        words = licenses.terms(text)
        found = [(self.cosine(licenses.terms(line), v), name) for line in text.split("\n") for name, v in self.lines]
        for name, v, length, needed, begins in self.blocks:
            for at in range(1 if begins else max(1, len(words) - length + 1)):
                block = words[at : at + length]
                if needed <= set(block) and not (needed and licenses.OTHERS & set(block)) and not v.keys().isdisjoint(block):
                    found.append((self.cosine(block, v), name))
        best = max(found, key=lambda x: x[0], default=(0.0, None))
        return (best[1], best[0]) if best[0] >= licenses.HEADER else (None, 0.0)


@pytest.fixture(scope="module")
def rows(spark, sf):
    """On ten times the documents of the other tests: few of those have a notice."""
    sf = f"{sf}/../sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    return texts, queries.op6_license_scans(spark, sf).collect()


def test_own_licences_are_those_of_plain_cosines(rows):
    texts, got = rows
    plain = Plain(list(texts.values()))
    assert len(got) == len(texts) and sum(r["own_license"] is not None for r in got) >= 10
    for r in got:
        name, cosine = plain.licence(texts[r["doc_id"]])
        assert r["own_license"] == name, r["doc_id"]
        if name:
            assert abs(r["similarity"] - cosine) < 2e-6


def test_files_inherit_from_the_nearest_directory_above(rows):
    _, got = rows
    grants = {}
    for r in got:
        folder, _, file = r["path"].rpartition("/")
        if r["own_license"] and re.match(licenses.LICENCE_FILE, file):
            grants.setdefault(folder, []).append((-r["similarity"], r["path"], r["own_license"]))
    for r in got:
        want = (r["own_license"], r["path"])
        if not r["own_license"]:
            parts = r["path"].split("/")[:-1]
            above = next((d for d in ("/".join(parts[:n]) for n in range(len(parts), -1, -1)) if d in grants), None)
            want = (min(grants[above])[2], above) if above is not None else (None, None)
        assert (r["license"], r["license_from"]) == want, r["path"]
