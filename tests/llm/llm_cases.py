"""Hand-made documents and plain-Python answers for the tests of this folder."""

from __future__ import annotations

import collections
import hashlib
import re
import string

import pyarrow.parquet as pq

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_id string, _key_id string, node string, tie string, row string, owner string, digest string, score string, kept string, places string, "
    "component string, size string, target string, _has_letter string"
)

LONG = " ".join(f"w{k * k % 997} v{k % 13}" for k in range(30_000))
PASSAGE = " ".join(f"passage{k}" for k in range(30))


def awkward_rows() -> list[tuple]:
    """Nulls in each column, empty and blank texts, copies, repeated rows, a very long text."""
    texts = [
        (1, "Alpha beta gamma delta epsilon zeta"), (2, "alpha  beta\tgamma delta epsilon zeta"), (3, None), (4, ""), (5, " \n\t "),
        (6, LONG), (7, LONG + " tail"), (8, "a"), (8, "a"), (9, "1234 5678 !!"), (10, f"first part {PASSAGE} then more"),
        (11, f"other words {PASSAGE} and an end"), (None, "no id here at all but some words"), (12, "Ünïcode ﬁ ▁ wörds 😀 \x00 x"), (13, PASSAGE + " " + PASSAGE),
        (14, "the mit license and the Apache License, CC BY; GNU General  Public\nLicense"),
    ]
    rows = [(i, t, "en", "web", 1) for i, t in texts]
    rows[0] = (1, texts[0][1], None, None, None)
    return [(*r, *["x"] * 14) for r in rows]


def sample_rows(table: str = "documents") -> list[dict]:
    return pq.read_table(f"{SF_DIR}/{table}.parquet").to_pylist()


def blank_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- brute force -------------------------------------------------------------
def substring_answer(rows: list[tuple], window: int = 20) -> dict:
    """rows: (id, text) with different ids, in order of the ids."""
    seen, out = set(), {}
    for i, text in rows:
        words = blank_words(text)
        gone = set()
        for p in range(len(words) - window + 1):
            gram = tuple(words[p : p + window])
            if gram in seen:
                gone.update(range(p, p + window))
            seen.add(gram)
        kept = " ".join(w for p, w in enumerate(words) if p not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def groups(links) -> dict:
    parent: dict = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {a: find(a) for a in list(parent)}


def shingles(text: str | None, size: int = 5) -> set:
    words = blank_words((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or {tuple(words)}


def jaccard_answer(rows: list[tuple]) -> dict:
    sets = {i: shingles(t) for i, t in rows}
    lists = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    links = [(i, i) for i in sets]
    for i, s in sets.items():
        common = collections.Counter(j for x in s for j in lists[x] if j > i)
        links += [(i, j) for j, n in common.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    component = groups(links)
    return {i: (len(s), component[i]) for i, s in sets.items()}
