"""Brute-force versions and small documents."""

import os
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
MIDDLE = os.environ.get("TEST_MIDDLE_DIR", "/root/testdata/sf0.01")
DOCS = "doc_id long, text string, source string, id string, x string"


def docs(spark, rows):
    """Rows (id, text) with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "s", "clash", "clash") for i, t in rows], DOCS)


def words(text, lower=False):
    data = (text or "").encode()
    return WORD.findall(data.translate(LOWER) if lower else data)


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a
