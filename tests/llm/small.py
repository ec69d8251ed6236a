"""Small tables and brute-force versions for the tests of this folder."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, key string, block int"
FR = "le la les des une est dans pour avec sur pas plus chat maison jardin rouge toujours été garçon".split()
EN = "the and that with this from have they which house garden always green water through boy".split()


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus(seed=7, n=60):
    """(doc_id, text, lang) with copies, near copies, shared passages, repeated
    lines, nulls, empty and long texts, and Unicode."""
    r = random.Random(seed)
    words = lambda bag, k: " ".join(r.choice(bag) + r.choice(["", "", "s", "X", "é"]) for _ in range(k))
    passage, line = words(EN, 60), "A line that stands in many documents, Ünïcode"
    out = []
    for i in range(n):
        fr = i % 2
        text = "\n".join(words(FR if fr else EN, r.randint(1, 60)) for _ in range(r.randint(1, 5)))
        if i % 5 == 0:
            text += "\n " + (line if i % 10 else line.upper().replace("Ü", "Ü")) + "\t\n" + text[:30]
        if i % 6 == 1:
            text = text[:40] + passage + text[40:]
        out.append((i, text, "fr" if fr else "en"))
    out += [(100, out[3][1], "fr"), (101, out[3][1] + " tail", "fr"), (102, out[2][1].replace("the", "thy", 1), None)]
    out += [(110, None, "en"), (111, "", "fr"), (112, " \n\t ", None), (113, "12 34 -- !!", "en"), (114, "a" * 700, None), (115, words(EN, 4000), "en"), (116, "日本語 テキスト " * 20, None)]
    out += [(117, "x", "en"), (118, "ab" * 400, None), (119, "one two three", "en"), (120, "\n" * 30, "en"), (121, "same line repeated here, long enough\n" * 5, "en")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, la, "s", len(t or ""), "x", "y", 1) for d, t, la in rows], DOCS)


def held(doc_id, n):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == 1


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))


def base_scores(rows, n=5):
    counts = Counter()
    for d, t, _ in rows:
        if not held(d, n):
            counts.update([*tokens(t), "\n"])
    total, types = sum(counts.values()), len(counts)
    out = []
    for d, t, _ in rows:
        w = [*tokens(t), "\n"]
        out.append((d, held(d, n), len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (types + 1))) for x in w)))
    return out


def repeated_bytes(rows, span=100):
    """{doc_id: (n_bytes, n_removed, n_spans, digest)}; ids must not repeat."""
    seen, out = set(), {}
    for d, t, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if b[i : i + span] in seen:
                gone[i : i + span] = True
            seen.add(b[i : i + span])
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def decontaminated(rows, items, size=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for item, text in items:
        w = re.findall(pattern, ascii_lower(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, t, _ in rows:
        w = re.findall(pattern, ascii_lower(t))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[g]
        found.discard(None)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return out


def simhash(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", ascii_lower(text).encode())
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius=4):
    """The smallest position that each position reaches."""
    group = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if group[i] != group[j] and (prints[i] ^ prints[j]).bit_count() <= radius:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    return group


def line_dedup(rows, least=20, documents=3):
    key = lambda x: ascii_lower(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x))
    holders = {}
    for d, t, _ in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(d)
    out = []
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= least and len(holders[key(x)]) >= documents and d != max(holders[key(x)], key=lambda v: (v is not None, v)))]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out
