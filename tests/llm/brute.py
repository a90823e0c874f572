"""The operators in plain Python, for small inputs."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def exact(docs):
    """The id that stays, for each id."""
    groups = defaultdict(list)
    for doc_id, text in docs.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(doc_id)
    return {k: min(group, key=lambda d: (-len(docs[d] or ""), d)) for group in groups.values() for k in group}


def shingles(text, n=5):
    found = [w.translate(LOWER) for w in words(text)]
    if not found:
        return set()
    return {tuple(found[k:k + n]) for k in range(len(found) - n + 1)} or {tuple(found)}


def components(docs, percent=80):
    sets = {doc_id: shingles(text) for doc_id, text in docs.items()}
    holders = defaultdict(list)
    for doc_id, grams in sets.items():
        for gram in grams:
            holders[gram].append(doc_id)
    common = Counter()
    for holding in holders.values():
        for k, a in enumerate(holding):
            for b in holding[:k]:
                common[min(a, b), max(a, b)] += 1
    parent = {doc_id: doc_id for doc_id in docs}

    def root(doc_id):
        while parent[doc_id] != doc_id:
            doc_id = parent[doc_id]
        return doc_id

    for (a, b), shared in common.items():
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {doc_id: root(doc_id) for doc_id in docs}


def quality(text):
    text = text or ""
    found = words(text)
    windows = Counter(tuple(found[k:k + 3]) for k in range(len(found) - 2))
    repeated = {k + s for k in range(len(found) - 2) if windows[tuple(found[k:k + 3])] > 1 for s in range(3)}
    lines = Counter(line for line in text.split("\n") if words(line))
    return {
        "n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(n - 1 for n in lines.values()), "n_repeat_words": len(repeated),
        "base_failed": len(found) < 50 or 100 * len(repeated) > 50 * len(found)}


def targets(sizes, cycle=(3, 1, 2), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {source: cycle[k % len(cycle)] for k, source in enumerate(order)}
    budget, found = share * sum(sizes.values()), {}
    free = dict(sizes)
    while free:
        level = budget / sum(weight[s] for s in free)
        full = [s for s in free if cap * sizes[s] < level * weight[s]]
        if not full:
            found |= {s: level * weight[s] for s in free}
            break
        for source in full:
            found[source] = cap * sizes[source]
            budget -= found[source]
            del free[source]
    return found


def held_out(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def base_scores(docs):
    """(n_tokens, n_known, train_tokens, base_score) of each id."""
    tokens = {k: [w.translate(LOWER) for w in words(text)] + [None] for k, text in docs.items()}
    count = Counter(t for k, found in tokens.items() if not held_out(k, 7, 2) for t in found)
    total, distinct = sum(count.values()), len(count)
    return {k: (len(found), sum(count[t] > 0 for t in found), total,
                sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in found)) for k, found in tokens.items()}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def pii(text):
    text = text or ""
    found = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append(f"ip:{m.start()}:{m.end()}")
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(f"card:{m.start()}:{m.end()}")
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(f"phone:{m.start()}:{m.end()}")
    return found
