"""Whole license texts are found in documents, however they are wrapped; halves of them are not."""

from riskframe.llm import license_scan


def test_bodies_are_found_whole(spark):
    assert len(license_scan.bodies()) >= 9
    bodies = {k: v for k, v in license_scan.bodies().items() if k in ("apache-2.0-text", "bsd-text", "cc0-1.0-text", "lgpl-3-text")}
    texts = {}
    for n, (name, text) in enumerate(bodies.items()):
        words = text.split()
        texts[10 * n] = "before it " + " ".join(words) + " after"
        texts[10 * n + 1] = "/* " + "\n * ".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))
        texts[10 * n + 2] = " ".join(words[:len(words) // 2])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {}
    for r in license_scan.scan(docs, license_scan.TEMPLATES | bodies).collect():
        found.setdefault(r["doc_id"], {})[r["license"]] = r["containment"]
    for n, name in enumerate(bodies):
        assert found[10 * n][name] == 1.0 and found[10 * n + 1][name] == 1.0
        assert name not in found.get(10 * n + 2, {})
