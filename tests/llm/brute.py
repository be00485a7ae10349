"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def repeated_bytes(docs: list[tuple], length: int = 100) -> dict:
    """{doc_id: (n_bytes, n_removed, n_spans, sha of what is kept)}"""
    seen, marks = set(), {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                mark[i : i + length] = b"\1" * length
            else:
                seen.add(window)
        marks[doc] = (data, mark)
    return {
        doc: (
            len(data),
            sum(mark),
            len(re.findall(b"\1+", bytes(mark))),
            sha(bytes(b for b, m in zip(data, mark, strict=True) if not m)),
        )
        for doc, (data, mark) in marks.items()
    }


def repeated_words(docs: list[tuple], length: int = 50) -> dict:
    """{doc_id: (n_words, n_removed, sha of the kept words)}"""
    first, words = {}, {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        words[doc] = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(words[doc]) - length + 1):
            first.setdefault(tuple(words[doc][i : i + length]), doc)
    out = {}
    for doc, own in words.items():
        gone = set()
        for i in range(len(own) - length + 1):
            if first[tuple(own[i : i + length])] < doc:
                gone.update(range(i, i + length))
        kept = [w for i, w in enumerate(own) if i not in gone]
        out[doc] = (len(own), len(gone), sha(" ".join(kept)))
    return out


def near_duplicates(docs: list[tuple], shingle: int = 4, distance: int = 4) -> dict:
    """{doc_id: (fingerprint, component_id)}"""
    import xxhash

    prints = {}
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        pieces = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
        pieces = pieces or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
        prints[doc] = sum(
            1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
        )
    ids = sorted(prints)
    least = {doc: doc for doc in ids}

    def root(doc):
        while least[doc] != doc:
            doc = least[doc]
        return doc

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = root(a), root(b)
                least[max(x, y)] = min(x, y)
    return {doc: (f"{prints[doc]:016x}", root(doc)) for doc in ids}


def recurring_lines(
    docs: list[tuple], least_docs=4, least_tokens=3, similarity=0.8, short_lines=True,
    long_tokens=50, long_chars=300, copies: dict | None = None,
) -> dict:
    """{doc_id: numbers of the lines that go}; `copies` is {doc_id: its group}"""
    any_token, places, holders = "<*>", [], {}
    for doc, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            raw = tuple(t for t in re.split(r"[\x20\x09-\x0D]+", line) if t)
            if not raw:
                continue
            tokens = tuple(any_token if re.search("[0-9]", t) else t for t in raw)
            variants = []
            if sum(t != any_token for t in tokens) >= least_tokens:
                variants.append(("masked", tokens))
            elif short_lines:
                variants.append(("exact", raw))
            if len(raw) >= long_tokens or len(line) >= long_chars:
                variants.append(("long", raw))
            for variant in variants:
                holder = copies.get(doc, doc) if copies and variant[0] == "long" else doc
                places.append((doc, at, variant, holder))
                holders.setdefault(variant, set()).add(holder)
    weight = {v: len(h) for v, h in holders.items()}

    def agreeing(group):
        """The variants of a group that agree with its constants."""
        total, constants = sum(weight[v] for v in group), {}
        for at in range(len(group[0][1])):
            counts = Counter()
            for v in group:
                counts[v[1][at]] += weight[v]
            common = [t for t, n in counts.items() if 2 * n >= total]
            if common:
                constants[at] = max(common, key=str.encode)
        return [
            v for v in group
            if sum(constants.get(i) == t for i, t in enumerate(v[1])) / len(v[1]) >= similarity
        ]

    def worth(group):
        return len(group) > 1 and sum(weight[v] for v in group) >= least_docs

    leaves: dict = {}
    for v in holders:
        if v[0] == "masked":
            leaves.setdefault((len(v[1]), v[1][:3]), []).append(v)
    template, fresh = {}, 0
    open_groups = [g for g in leaves.values() if worth(g)]
    while open_groups:
        finer = []
        for group in open_groups:
            fits = agreeing(group)
            fresh += 1
            template |= dict.fromkeys(fits, fresh)
            rest = [v for v in group if v not in set(fits)]
            if not worth(rest):
                continue
            total, held = sum(weight[v] for v in rest), Counter()
            for v in rest:
                for at, t in enumerate(v[1]):
                    held[at, t] += weight[v]
            parts: dict = {}
            for v in rest:
                own = [
                    (held[at, t], -at, t.encode()) for at, t in enumerate(v[1])
                    if least_docs <= held[at, t] < total
                ]
                if own or len(rest) < len(group):
                    parts.setdefault(max(own)[1:] if own else None, []).append(v)
            finer += [p for p in parts.values() if worth(p)]
        open_groups = finer

    held_by: dict = {}
    for v, found in holders.items():
        held_by.setdefault(template.get(v, v), set()).update(found)
    gone: dict = {doc: set() for doc, _ in docs}
    for doc, at, v, holder in places:
        found = held_by[template.get(v, v)]
        least = min(2, least_docs) if v[0] == "long" else least_docs
        if len(found) >= least and holder != min(found):
            gone[doc].add(at)
    return {doc: sorted(at) for doc, at in gone.items()}


def contaminated(docs: list[tuple], items: list[str], window: int = 10) -> set:
    """Ids of the documents that hold a window of an item."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    wanted = set()
    for item in map(words, items):
        n = min(window, len(item))
        wanted.update(tuple(item[i : i + n]) for i in range(len(item) - n + 1) if n)
    lengths = {len(w) for w in wanted}
    return {
        doc
        for doc, own in ((d, words(t)) for d, t in docs)
        if any(tuple(own[i : i + n]) in wanted for n in lengths for i in range(len(own) - n + 1))
    }


def ranked(docs: list[tuple], items: list[tuple], best: int = 10) -> list[tuple]:
    """(item_id, rank, doc_id, score), scoring every document for every item"""

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))

    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, tf in counts:
            m = 100 - 90 + (90 * tf.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in set(terms(text))
                if t in tf
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        found = enumerate(sorted(scores)[:best], 1)
        out += [(item, i, None if none else doc, -score) for i, (score, none, doc) in found]
    return sorted(out, key=lambda r: r[:2])


def trie(rows: list[tuple], group: int = 20, most: int = 4) -> list[tuple]:
    """The nodes of the trie of rebuilt conversations, from (conv_id, turn, role, text)"""
    own: dict = {}
    for conv, turn, role, text in rows:
        own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = own.get(c - int(math.fmod(c, group)), [])[:h] + turns[h:]
    members: dict = {}
    for c, turns in whole.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for depth in range(len(p) + 1):
            saved[p[:depth]] += (len(convs) - 1) * words
            leaves[p[:depth]] += not children[p]
    return sorted(
        (
            (
                min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p],
                leaves[p], saved[p],
                sha(",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(p))))),
            )
            for p, convs in members.items()
        ),
        key=lambda r: r[:2],
    )
