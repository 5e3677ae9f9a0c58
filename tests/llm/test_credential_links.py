"""Secret scans against a plain version that tries every pair of parts."""

import hashlib
import random

import regex

from dealsieve.llm import credential_links as K
from dealsieve.llm.queries import QUERIES

from .helpers import awkward_rows, clashing, frame

KEYS = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "user", "login", "host", "client_id", "account"]


def plain_parts(text):
    """The base parts by walking runs and characters, the weak ones by the patterns."""
    out = {"assign": [], "access": [], "hex": []}
    for m in regex.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                            r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            out["assign"].append(m.span())
    for m in regex.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out["access"].append(m.span())
    for m in regex.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out["hex"].append(m.span())
    strong = sum(out.values(), [])
    apart = lambda s, others: all(s[1] <= o[0] or o[1] <= s[0] for o in others)
    out["identifier"] = [m.span() for m in K.IDENTIFIER.finditer(text) if apart(m.span(), strong)]
    out["endpoint"] = [m.span() for m in K.ENDPOINT.finditer(text) if apart(m.span(), strong)]
    out["key"] = [m.span() for m in K.KEY.finditer(text) if K._mixed(m)
                  and apart(m.span(), strong + out["identifier"] + out["endpoint"])]
    return out


def plain_scan(text):
    found = plain_parts(text)
    blank = [m.end() for m in regex.finditer(r"\n[ \t\r]*(?=\n)", text)]
    scope = lambda s: sum(b <= s[0] for b in blank)
    gap = lambda a, b: max(b[0] - a[1], a[0] - b[1], 0)
    joined = lambda a, b: scope(a) == scope(b) and gap(a, b) <= K.REACH
    ids, secrets = found["access"] + found["identifier"], found["assign"] + found["hex"] + found["key"]
    kept = {k: found[k] for k in K.BASE}
    kept["identifier"] = [a for a in found["identifier"] if any(joined(a, b) for b in secrets)]
    kept["key"] = [a for a in found["key"] if any(joined(a, b) for b in ids)]
    kept["endpoint"] = [a for a in found["endpoint"] if any(joined(a, b) for b in ids) and any(joined(a, b) for b in secrets)]
    spans = sorted(((s, K.KINDS.index(k), k, e) for k in kept for s, e in kept[k]))
    links = []
    for a in sorted(ids):
        near = [(gap(a, b), b[0]) for b in secrets if joined(a, b)]
        if near:
            ends = [(gap(a, b), b[0]) for b in kept["endpoint"] if joined(a, b)]
            links.append((a[0], min(near), min(ends) if ends else None))
    return [(k, s, e) for s, _, k, e in spans], links


def noise(rng, n):
    pieces = ["the", "of", "é", "\n", "\n\n", "\n \n", "AKIA", "AKIA" + "Z9" * 9, "0123456789abcdef" * 2, "deadbeef",
              "https://db.example.org:5432/x", "host = srv1", "a1B2" * 5, "user: bob", "x" * 30, "login=al", ", ", "=", ":", "'", '"']
    out = []
    for _ in range(n):
        if rng.random() < 0.3:
            out.append(rng.choice(KEYS) + rng.choice(["", "'", '"']) + " " * rng.randint(0, 2) + rng.choice("=: ")
                       + " " * rng.randint(0, 1) + rng.choice(["", '"']) + rng.choice(["abc", "abcdef", "a.b=c/d", "token", "x9Y" * 6]))
        else:
            out.append(rng.choice(pieces))
        out.append(rng.choice([" ", "", " filler " * rng.randint(0, 12)]))
    return "".join(out)


def test_equals_plain_version_on_noise():
    rng = random.Random(3)
    kinds, linked = set(), 0
    for n in [0, 1, 5, 20, 60] * 60:
        text = noise(rng, n)
        spans, links = K.link(text)
        want_spans, want_links = plain_scan(text)
        assert spans == want_spans
        assert len(links) == len(want_links)
        found = plain_parts(text)
        for (a, b, c), (w, secret, endpoint) in zip(links, want_links):      # the gap is the smallest there is
            own = [s for s in found["access"] + found["identifier"] if s[0] == w]
            near = [max(s[0] - o[1], o[0] - s[1], 0) for o in own for k in ("assign", "hex", "key") for s in found[k] if s[0] == b]
            assert a == w and min(near) == secret[0] and (c is None) == (endpoint is None)
            if c is not None:
                assert min(max(c - o[1], o[0] - e, 0) for o in own for s, e in found["endpoint"] if s == c) == endpoint[0]
        kinds |= {k for k, _, _ in spans}
        linked += len(links)
    assert kinds == set(K.KINDS) and linked > 100


def test_weak_parts_need_their_complement():
    key = "Zk3vQ9xT1mB7pL5w"
    assert K.link(f"a checksum {key} alone")[0] == []
    assert K.link("user: bob went home")[0] == []
    assert [k for k, _, _ in K.link(f"user: bob and {key}")[0]] == ["identifier", "key"]
    assert K.link(f"user: bob\n\n{key}")[0] == []                                   # another scope
    assert K.link(f"user: bob {'. ' * 101}{key}")[0] == []                          # out of reach
    spans, links = K.link(f"AKIA{'A1' * 8}\n{key}\nhttps://db.example.org/x")
    assert [k for k, _, _ in spans] == ["access", "key", "endpoint"] and links == [(0, 21, 38)]
    assert [k for k, _, _ in K.link("https://db.example.org/x token=abcdef1")[0]] == ["assign"]


def test_a_failing_match_uses_up_its_text():
    assert K.link("token = token: abcdef")[0] == []
    assert K.link("tokeN = Key secret=abcdefg")[0] == [("assign", 12, 26)]


def test_many_parts_cost_no_pairs():
    text = " ".join(f"user: bob{i} Zk3vQ9xT1mB7pL{i:04d}" for i in range(30_000))
    spans, links = K.link(text)
    assert len(spans) == 60_000 and len(links) == 30_000


def digest(found, base):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found if k in K.BASE or not base)


def test_query_on_awkward_rows(spark, tmp_dir):
    rng = random.Random(5)
    rows = awkward_rows() + [(2000 + i, noise(rng, 40), "en", "a", 1) for i in range(30)]
    rows += [(3000, "word " * 200_000 + "password=hunter22", "en", "a", 1)]
    for make in (frame, clashing):
        path = f"{tmp_dir}/{make.__name__}"
        make(spark, rows).write.parquet(f"{path}/documents.parquet")
        out = sorted([tuple(r) for r in QUERIES["op12_credential_links"](spark, path)
                      .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()], key=str)
        want = []
        for r in rows:
            found, _ = plain_scan(r[1] or "")
            count = [sum(k == kind for k, _, _ in found) for kind in K.BASE]
            want.append((r[0], *count, hashlib.sha256(digest(found, True).encode()).hexdigest(), digest(found, False)))
        assert out == sorted(want, key=str)
    assert K.scan_credentials(frame(spark, rows).limit(0)).count() == 0
