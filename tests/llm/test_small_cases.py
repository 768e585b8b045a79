"""Secrets, token counts, line removal and mixing: plain Python, nulls, ties, empty tables, clashing names."""

import collections
import hashlib
import random
import re

import pytest

from strandlake.llm import line_dedup as ld
from strandlake.llm import mixing as mx
from strandlake.llm import secret_scan as ss
from strandlake.llm import token_counts as tc


def docs(spark, rows):
    """(doc_id, text, source, lang) with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "a", 1, "b") for r in rows], "doc_id long, text string, source string, lang string, body string, tokens int, site string")


HEXES = "0123456789abcdef" * 2
SECRETS = [
    None, "", "token = \"abcd1234efgh\" x", "password: short", "passwd='12345678'", "API-KEY=zzzz9999yyyy", "my_apikey = Zzz999Yyy888", f"x {HEXES} y", "AKIA" + "Q" * 12, "AKIA" + "Q" * 11,
    "é" * 5 + " Token=\"" + HEXES + "\"", "paſſword=abcdefghijk", "secret=" + "a" * 5000, "token=12345678token=12345678",
]


def plain_base(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_secrets(spark):
    rows = [(i, t, "s", "en") for i, t in enumerate(SECRETS)] + [(None, SECRETS[2], None, None), (2, SECRETS[2], "s", "en")]
    got = ss.scan_secrets(docs(spark, rows)).collect()
    want = sorted((str(i), [tuple(x) for x in plain_base(t)]) for i, t, _, _ in rows)
    assert sorted((str(x.doc_id), [(s.kind, s.start, s.end) for s in x.found if s.kind != "literal"]) for x in got) == want
    assert all(s.value == (rows_by[x.doc_id] or "")[s.start : s.end] for rows_by in [{r[0]: r[1] for r in rows}] for x in got for s in x.found)
    assert ss.scan_secrets(docs(spark, [])).collect() == []


def test_long_random_texts_agree_with_the_patterns():
    r = random.Random(3)
    for _ in range(200):
        text = "".join(r.choice(["token", "=", '"', " ", "ab12", "AKIA", "QQ99", "f0f0f0f0f0", "é", "\n", "Secret", ":", "-"]) for _ in range(80))
        assert [(s.kind, s.start, s.end) for s in ss.scan_text(text)[0]] == plain_base(text)


@pytest.mark.parametrize("text,found", [
    ('db_pwd = "Xk29-qLm!7zR"', ["Xk29-qLm!7zR"]),
    ('k = "Xk29-qLm!7zRt"\nclientCredential = k\n', ["Xk29-qLm!7zRt"]),
    ('a = "Xk29qLm7" + "zRt5Vw2p"\nauth_secret = a', ["Xk29qLm7", "zRt5Vw2p"]),
    ("cfg['signing_passphrase'] = 'hunter2Zq9!x'", ["hunter2Zq9!x"]),
    ('title = "Xk29-qLm!7zR"', []), ('db_pwd = "changeme"', []), ('db_pwd = "${DB_PWD}"', []), ("He said: nothing of the kind", []),
])
def test_assignments(text, found):
    assert [text[s.start : s.end] for s, _, _ in ss.scan_text(text)[1]] == found


def literals(text):
    return [text[s.start : s.end] for s, _, _ in ss.assigned_spans(text)]


@pytest.mark.parametrize("text", ["k: " + "&a " * 2000 + "v", "a={" * 100_000, "x: 1 " + "a-" * 300_000, "x: 1 " + "$" * 300_000, "a--" * 200_000 + "=", "<a>" * 100_000, "name: x\n" * 50_000])
def test_deep_and_long_runs_take_little(text):
    import time
    import tracemalloc

    tracemalloc.start()
    begun = time.process_time()
    ss.assigned_spans(text)
    taken = time.process_time() - begun
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert taken < 30 and most < 300 << 20


@pytest.mark.parametrize(
    "text",
    [
        "name: DB_PWD\nother: " + "x" * 5000 + "\n\nvalue: Zx9kQ2mN8pLr",
        "- name: DB_PWD\n  note: a\n  value: Zx9kQ2mN8pLr\n- name: B\n  value: Ab9kQ2mN8pLr",
        '{"name": "DB_PWD", "inner": {"name": "x"}, "value": "Zx9kQ2mN8pLr"}',
        '<add key="db.pwd"\n  value="Zx9kQ2mN8pLr"/>',
        "<name>db.pwd</name>\n  <value>Zx9kQ2mN8pLr</value>",
        "<pwd> Zx9kQ2mN8pLr </pwd>",
        "k: &a &b &c Zx9kQ2mN8pLr\npwd: *b",
        'my-set("pwd", "Zx9kQ2mN8pLr")',
    ],
)
def test_values_are_bound_by_scope(text):
    assert literals(text) == ["Zx9kQ2mN8pLr"]


@pytest.mark.parametrize("text", ["- name: DB_PWD\n- value: Zx9kQ2mN8pLr", '[{"name": "DB_PWD"}, {"value": "Zx9kQ2mN8pLr"}]', '<add key="db.pwd"/><add value="Zx9kQ2mN8pLr"/>', "<name>db.pwd</name> and <value>Zx9kQ2mN8pLr</value>"])
def test_values_of_another_scope(text):
    assert literals(text) == []


def test_all_literals_of_a_name_are_scored():
    parts = [f"Xk{i:03d}-qLm!7zR" for i in range(150)]
    one = "a = " + " + ".join(f'"{p}"' for p in parts) + "\nauth_secret = a"
    many = 'a = ""\n' + "".join(f'a = a + "{p}"\n' for p in parts) + "auth_secret = a"
    for text in (one, many):
        assert [text[s.start : s.end] for s, _, _ in ss.scan_text(text)[1]] == parts
    text = 'key1 = "Xk29-qLm!7zRt"\nclientCredential = key1\n'
    assert [(text[s.start : s.end], n) for s, n, _ in ss.scan_text(text)[1]] == [("Xk29-qLm!7zRt", "clientCredential")]
    assert len(ss.scan_text("a = a + a\n" * 5000 + many)[1]) == 150


SECRET = "Xk29-qLm!7zRt"


@pytest.mark.parametrize("text", [
    "db:\n  host: here\n  password_value: " + SECRET, "secrets:\n  - name: x\n  - " + SECRET, "[credentials]\nmain = " + SECRET,
    '{"db": {"host": "h", "passphrase": "' + SECRET + '"}}', '{"credentials": ["a", "' + SECRET + '"]}', 'client_pwd = """' + SECRET + '"""', "client_pwd = \'\'\'\n  " + SECRET + "\n\'\'\'",
    'password_value = K\nK = "' + SECRET + '"', 'base: &a ' + SECRET + "\nclient_pwd: *a", 'a = "' + SECRET + '"\nclient_pwd = f"x{a}y"', 'a = "' + SECRET + '"\nclient_pwd = x.y + a',
    'client_pwd: str = "' + SECRET + '"', "client_pwd: |\n  " + SECRET + "\nnext: 1", "<add key=\"client_pwd\" value=\"" + SECRET + "\"/>", "- name: CLIENT_PWD\n  value: " + SECRET,
    "define('CLIENT_PWD', '" + SECRET + "')", "connect(host='h', client_pwd='" + SECRET + "')", "postgres://me:" + SECRET + "@host/db", "Authorization: Bearer " + SECRET,
    "x" * 500 + "_pwd = '" + SECRET + "'", 'client_pwd = b64decode("' + SECRET + '")', "# client_pwd = '" + SECRET + "'", "run --client-pwd=" + SECRET,
    'a = "x"\nb = a\na += "' + SECRET + '"\nclient_pwd = a', "it's client_pwd = '" + SECRET + "' isn't it",
])
def test_syntax(text):
    assert SECRET in [text[s.start : s.end] for s, _, _ in ss.scan_text(text)[1]], ss.lex(text)


@pytest.mark.parametrize("text", ["He said: it's a key: don't", 'client_pwd = os.getenv("CLIENT_PWD")', "title: " + SECRET, 'a = "' + SECRET + '"\na = "x"\nclient_pwd = a', "a: " + "(" * 3000 + "=" * 3000, "a.b=" * 3000, "'" * 5000 + "=", "x" * 300_000 + " = 1"])
def test_no_secret(text):
    assert ss.scan_text(text)[1] == []


def test_propagation_brute():
    """Random programs: which literals reach a sensitive name, by following every name again and again."""
    r = random.Random(12)
    for _ in range(150):
        names = [f"n{i}" for i in range(6)] + ["auth_pwd", "client_pwd"]
        lines, literal = [], 0
        for _ in range(r.randint(1, 14)):
            parts = []
            for _ in range(r.randint(1, 3)):
                if r.random() < 0.5:
                    parts.append(f'"Xk{literal:03d}-qLm!7zR"')
                    literal += 1
                else:
                    parts.append(r.choice(names))
            lines.append((r.choice(names), r.choice(["=", "=", "+="]), parts))
        text = "\n".join(f"{n} {op} {' + '.join(parts)}" for n, op, parts in lines)

        def before(name, i):
            own = [j for j in range(i) if lines[j][0] == name] or [j for j in range(i + 1, len(lines)) if lines[j][0] == name][:1]
            return own[-1] if own else None

        holds = [{p for p in parts if p[0] == '"'} for _, _, parts in lines]
        for _ in range(len(lines) + 1):
            for i, (n, op, parts) in enumerate(lines):
                for p in [*(p for p in parts if p[0] != '"'), *([n] if op == "+=" else [])]:
                    j = before(p, i)
                    holds[i] |= holds[j] if j is not None else set()
        want = {x.strip('"') for (n, _, _), held in zip(lines, holds) if n in names[6:] for x in held}
        assert {text[s.start : s.end] for s, _, _ in ss.scan_text(text)[1]} == want, text


def counter(chunk, overlap):
    import public_tokenizers

    return tc.PieceCounter(public_tokenizers.path(tc.MODEL), chunk, overlap)


def test_spliced_counts_are_the_library_s():
    r = random.Random(6)
    tool = counter(40, 2)
    parts = ["a", "the ", "  ", "\n", "é", "ｆ", "😀", "<s>", "▁", "token", "...", "ing", "\t", "zz"]
    for _ in range(150):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 200)))
        assert tool.count(text) == len(tool.processor.encode(text)), repr(text)
    assert tool.widened
    assert counter(50, 1).count("a" * 700) == len(tool.processor.encode("a" * 700))


def test_models_with_unused_pieces(tmp_path):
    """Unused pieces are merged and split up again: no splice may lie inside of them."""
    import public_tokenizers
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    with open(public_tokenizers.path(tc.MODEL), "rb") as file:
        spec.ParseFromString(file.read())
    gone = [p for p in spec.pieces if p.type == 1 and len(p.piece) > 3][::7]
    for p in gone:
        p.type = 5
    (tmp_path / "unused.model").write_bytes(spec.SerializeToString())
    tool = tc.PieceCounter(str(tmp_path / "unused.model"), 40, 2)
    r = random.Random(9)
    words = [p.piece.replace("▁", " ") for p in gone[:400]]
    for _ in range(80):
        text = "".join(r.choice(words) for _ in range(r.randint(10, 60)))
        assert tool.count(text) == len(tool.processor.encode(text)), repr(text)
    assert tool.literal


def test_token_counts(spark):
    texts = [None, "", "a b", "é" * 3000, "word " * 9000]
    rows = [(i, t, "s", "en") for i, t in enumerate(texts)] + [(None, "a b", None, None)]
    tool = counter(1 << 30, 1)
    got = tc.count_tokens(docs(spark, rows), chunk=500, overlap=8).collect()
    assert sorted((str(x.doc_id), x.n_bytes, x.n_tokens) for x in got) == sorted((str(i), len((t or "").encode()), len(tool.processor.encode(t or ""))) for i, t, _, _ in rows)
    assert tc.count_tokens(docs(spark, [])).collect() == []


@pytest.mark.parametrize("min_sites,broadcast", [(1, 10), (2, 10), (3, 0), (5, 100)])
def test_line_removal(spark, min_sites, broadcast):
    r = random.Random(min_sites)
    lines = [f"line {i}" for i in range(12)] + ["", "  ", "é é"]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 6))), r.choice(["a", "b", "c", "d", "e", None]), "en") for i in range(60)]
    rows += [(100, None, "a", "en"), (None, "line 1\nline 1", "b", "en"), (101, "only here", "a", "en"), (101, "only here", "a", "en"), (102, "x\n" * 3000, "a", "en")]
    sites = collections.defaultdict(set)
    for _, t, s, _ in rows:
        for line in (t or "").split("\n"):
            if line.strip():
                sites[line].add(s or "")
    wide = {x for x, s in sites.items() if len(s) >= min_sites}
    want = sorted((str(i), sum(bool(x.strip()) for x in (t or "").split("\n")), sum(x in wide for x in (t or "").split("\n")), None if t is None else "\n".join(x for x in t.split("\n") if x not in wide)) for i, t, _, _ in rows)
    got = ld.remove_lines(docs(spark, rows), min_sites, broadcast_lines=broadcast).collect()
    assert sorted((str(x.doc_id), x.n_lines, len(x.removed), x.kept_text) for x in got) == want


def test_lines_empty(spark):
    assert ld.remove_lines(docs(spark, [])).collect() == []


def rake(cells, targets, sweeps):
    w = dict(cells)
    for _ in range(sweeps):
        for d in range(3):
            held = collections.Counter()
            for k, v in w.items():
                held[k[d]] += v
            w = {k: v * targets[d].get(k[d], 0) / held[k[d]] if held[k[d]] else 0.0 for k, v in w.items()}
    return w


def test_raking_and_budget(spark):
    r = random.Random(9)
    rows = [(i, "w " * r.randint(1, 60) + r.choice(["", " | ", "##"]), r.choice(["a"] * 6 + ["b", "c", None]), r.choice(["en", "en", "fr"])) for i in range(400)]
    rows += [(900, None, "a", "en"), (901, "", "a", "en"), (5, "w w w", "a", "en"), (None, "w w", "b", "fr")]
    got = mx.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    cells = collections.Counter()
    for x in got:
        cells[x.mix_source, x.mix_lang, x.mix_topic] += x.mix_tokens
    total = sum(cells.values())
    targets = []
    for d in range(3):
        share = collections.Counter()
        for k, v in cells.items():
            share[k[d]] += v
        power = {k: v**mx.TEMPERATURE for k, v in share.items()}
        targets.append({k: v / sum(power.values()) for k, v in power.items()})
    want = rake(cells, targets, mx.SWEEPS)
    keep = {}
    for x in got:
        k = (x.mix_source, x.mix_lang, x.mix_topic)
        assert x.mix_weight == pytest.approx(want[k], rel=1e-9)
        keep[k] = x.mix_keep
        draw = int(hashlib.md5(f"{'' if x.doc_id is None else x.doc_id}:{mx.SEED}".encode()).hexdigest()[:13], 16) / 2**52
        assert x.mix_selected == (draw < x.mix_keep)
    assert sum(keep[k] * v for k, v in cells.items()) == pytest.approx(mx.FRACTION * total)
    free = {want[k] / (keep[k] * v) for k, v in cells.items() if keep[k] < 1}
    assert max(free) == pytest.approx(min(free)) and all(want[k] / v >= max(free) * (1 - 1e-9) for k, v in cells.items() if keep[k] == 1)


def test_many_cells_and_few_cells_agree(spark):
    r = random.Random(4)
    rows = [(i, "w " * r.randint(1, 60) + r.choice(["", " | "]), r.choice("aab"), r.choice(["en", "en", "fr"])) for i in range(150)]
    told = lambda n: {x.doc_id: (round(x.mix_weight, 9), round(x.mix_keep, 9), x.mix_selected) for x in mx.mix(docs(spark, rows), few_cells=n).collect()}
    assert told(1) == told(10**5)


def test_targets_that_no_weights_meet(spark):
    """Each source has one language: targets for both that disagree are told, not passed over."""
    rows = [(i, "w w w", "ab"[i % 2], ["en", "fr"][i % 2]) for i in range(100)]
    goal = lambda dim, **p: spark.createDataFrame(list(p.items()), f"{dim} string, {dim}_target double")
    goals = {"mix_source": goal("mix_source", a=0.9, b=0.1), "mix_lang": goal("mix_lang", en=0.2, fr=0.8), "mix_topic": goal("mix_topic", prose=1.0)}
    assert mx.mix(docs(spark, rows), targets=goals).count() == 100
    with pytest.raises(ValueError, match="raking"):
        mx.mix(docs(spark, rows), targets=goals, strict=True)


def test_clashing_mixing_columns_are_renamed(spark):
    from pyspark.sql import functions as F

    frame = docs(spark, [(i, "w w w", "ab"[i % 2], "en") for i in range(20)]).withColumns({"mix_keep": F.lit("own"), "mix_source": F.lit(7), "mix_weight": F.lit(None), "tokens": F.lit(3), "weight": F.lit(1.0)})
    got = mx.mix(frame).collect()
    assert len(got) == 20 and all(x.mix_keep_input == "own" and x.mix_source_input == 7 and x.mix_source in "ab" and x.tokens == 3 for x in got)


def test_given_targets_and_empty(spark):
    rows = [(i, "w w w", "ab"[i % 2], "en") for i in range(100)]
    frame = docs(spark, rows)
    goal = lambda dim, **p: spark.createDataFrame(list(p.items()), f"{dim} string, {dim}_target double")
    goals = {"mix_source": goal("mix_source", a=0.25, c=0.5), "mix_lang": goal("mix_lang", en=1.0), "mix_topic": goal("mix_topic", prose=1.0)}
    got = mx.mix(frame, targets=goals, fraction=0.4).collect()
    assert {(x.mix_source, round(x.mix_keep, 9)) for x in got} == {("a", 0.8), ("b", 0.0)}
    assert mx.mix(docs(spark, [])).collect() == []
