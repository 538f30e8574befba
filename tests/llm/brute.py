"""Plain versions of what the operators promise, one document or pair at a time."""

import hashlib
import math
import re
import zlib

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def joined(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, kinds.index(k), k, b) for k, a, b in spans))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n // 10 + n % 10
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
}
SECRETS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
}


def spans(text, table):
    """(kind, start, end) of the leftmost matches of each kind that its check accepts."""
    return [(k, *m.span()) for k, (pattern, good) in table.items() for m in re.finditer(pattern, text or "", re.ASCII) if good(m)]


def entropies(text):
    """(start, end) of the high-entropy strings beside what the base patterns match: every window's entropy, from scratch."""
    text = text or ""
    for pattern in (SECRETS["assign"][0], r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"):
        text = re.sub(pattern, lambda m: " " * len(m[0]), text, flags=re.ASCII)
    word = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]{1,4})"
    plain = [rf"[/+_=-]*(?:{word}[/+_=-]+)*(?:{word})?", "[0-9]+", "[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", "(?:[A-Za-z]+[/_=-])+[A-Za-z]*[0-9]{1,4}"]
    out = []
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        s = m[0].strip("=_+-")
        start = m.start() + len(m[0]) - len(m[0].lstrip("=_+-"))
        if len(s) < 20 or not re.search("[A-Za-z]", s) or any(re.fullmatch(x, s) for x in plain) or re.search("(?i)example|sample|dummy|placeholder|changeme|abcdefgh|12345678", s):
            continue
        best = max(-sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w)) for w in (s[i : i + 20] for i in range(len(s) - 19)))
        if best >= (3.0 if re.fullmatch("[0-9a-fA-F]+", s) else 3.6):
            out.append((start, start + len(s)))
    return out


def line_dedup(docs):
    """doc_id: (n_lines, n_dropped, kept text)."""
    key = lambda x: x.strip(SPACE).translate(LOWER)
    holders = {}
    for doc, text in docs.items():
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, set()).add(doc)
    out = {}
    for doc, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(k := key(x)) < 10 or len(holders[k]) < 2 or min(holders[k]) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def warc(pages):
    """page_id: (payload_bytes, payload_digest, record_type, refers_to)."""
    raw = {p: (h or "").encode() for p, h in pages.items()}
    first = {}
    for p in sorted(raw):
        if len(raw[p]) >= 100:
            first.setdefault(raw[p], p)
    return {p: (len(x), sha(x), *(("revisit", first[x]) if first.get(x, p) != p else ("response", None))) for p, x in raw.items()}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def smallest(nodes, links):
    """The least node that each node reaches."""
    of = {x: x for x in nodes}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        of[b] = a
    return {x: root(x) for x in nodes}


def near_duplicates(docs):
    """doc_id: (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in docs.items()}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    found = smallest(ids, links)
    return {d: (len(sets[d]), found[d]) for d in ids}


def pieces(docs, tokenizer, capacity=4096):
    """(doc_id, piece): (start, length, crc32)."""
    out = {}
    for d, text in docs.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out[d, i] = (at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))
    return out


DIGIT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items):
    """doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = {}
    for i, text in items.items():
        w = DIGIT_WORD.findall((text or "").translate(LOWER))
        n = min(10, len(w))
        for a in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[a : a + n]), set()).add(str(i))
    sizes = {len(x) for x in windows}
    out = {}
    for d, text in docs.items():
        w = DIGIT_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if own := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= own
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


def repeats(docs, length=100):
    """doc_id: (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for d in sorted(docs):
        raw = (docs[d] or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if (w := raw[a : a + length]) in seen:
                gone[a : a + length] = b"\x01" * length
            seen.add(w)
        out[d] = (len(raw), sum(gone), len(re.findall(b"\x01+", bytes(gone))), sha(bytes(x for x, g in zip(raw, gone) if not g)))
    return out
