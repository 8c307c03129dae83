"""Secrets: what counts, what does not, and redaction that leaves the rest alone."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparvane.llm import secrets
from sparvane.llm.automaton import Automaton

RANDOM = "q7Rt2LmZ9xWc4VbN8kJh3GfD6sPa1YeU"
HEX = "3f9a" * 10
KEY = "-----BEGIN RSA PRIVATE KEY-----\n" + "aB3x" * 30 + "\n-----END RSA PRIVATE KEY-----"
HELD = [
    ("headers", '{"Authorization": "Bearer %s"}' % RANDOM, RANDOM),
    ("headers", '{"X-Api-Key":"%s"}' % HEX, HEX),
    ("code", f"const apiKey = `{RANDOM}`;\nreturn x;", RANDOM),
    ("code", f"var k = '{HEX}';", HEX),
    ("env", f"MODE=prod\nABC_SECRET={RANDOM}=\nRETRIES=1", RANDOM + "="),
    ("url", f"https://a.example/b?limit=1&api_key={RANDOM}&x=1", RANDOM),
    ("url", "https://me:aB3dE5fG7h@a.example/b", "aB3dE5fG7h"),
    ("connection", "Server=a;Uid=b;Pwd=Ab3&dE5fG7;", "Ab3&dE5fG7"),
    ("connection", "Server=a;Uid=b;Pwd=waru.LOPE85;", "waru.LOPE85"),
    ("command", "curl -s -u me:aB3dE5fG7h https://a.example", "aB3dE5fG7h"),
    ("db_pw", "aB3dE5fG7h!", "aB3dE5fG7h!"),
    ("value2", "key_live_" + RANDOM, "key_live_" + RANDOM),
    ("config", "db:\n  user: x\n  password: 'Ab%9!xyz12'\n", "Ab%9!xyz12"),
    ("code", 'password         = "Abcd1234xyz"', "Abcd1234xyz"),
    ("code", 'let password: "correcthorsebattery"', "correcthorsebattery"),
    ("code", 'password="my-P4ssw0rd-77"', "my-P4ssw0rd-77"),
    ("code", "pwd = '$ecretPass99'", "$ecretPass99"),
    ("config", '{"k": "%s"}' % RANDOM, RANDOM),
    ("config", '{\\"password\\": \\"aB3dE5fG7h\\"}', "aB3dE5fG7h"),
    ("config", "pw=a1!", "a1!"),
]
FREE = [
    ("headers", '{"Authorization": "Bearer {{ $credentials.a.token }}"}'), ("headers", '{"X-Api-Key": "YOUR_API_KEY"}'), ("headers", '{"X-Api-Key": "${API_KEY}"}'),
    ("code", "const apiKey = process.env.MY_KEY;"), ("code", "const apiKey = null;"), ("code", "const apiKey = '';"), ("code", "const apiKey = $vars.abcdef1;"),
    ("env", "ABC_API_KEY=\nTIMEOUT=79"), ("password", "xxxxxxxx"), ("password", "<password>"), ("password", "={{ $credentials.a.password }}"), ("password", ""),
    ("cert", KEY.replace("RSA PRIVATE", "PUBLIC")), ("cert", KEY.replace("RSA PRIVATE KEY", "CERTIFICATE")), ("commit", f"Pinned to commit {HEX} of x"),
    ("checksum", "sha256:" + "ab12" * 16), ("etag", 'W/"%s"' % HEX[:32]), ("url", "https://a.example/b?access_token=********"), ("url", "https://a.example/b?access_token=TOKEN_HERE"),
    ("connection", "pgsql://me:${DB_PASSWORD}@a.example/b"), ("options", '{"max_tokens":3176,"token_field":"abcdefgh","secret":null}'),
    ("fields", '[{"label":"Password","type":"password","required":true}]'), ("content", "Never paste a password or an API key here; team x keeps them."),
    ("config", '{"commit": "%s", "file_id":"%s"}' % (HEX, RANDOM)), ("code", "password = $json.password"), ("code", "let key = $apiKey;"), ("fields", '{"secret": "required", "password": "password"}'),
    ("webhook_id", "69a9a152-4aa1-f476-8889-267ea60caa56"), ("text", "Keep-at-most-479-shipments-per-locordu-run,-see-kocaja."),
]


@pytest.mark.parametrize(("name", "value", "secret"), HELD)
def test_found_and_masked(name, value, secret):
    spans = secrets.secret_spans(name, value)
    assert [value[a:b] for a, b, _ in spans] == [secret]
    masked = secrets.redact(value, spans)
    assert secret not in masked and re.sub(r"<\w+-redacted>", lambda m: secret, masked) == value
    assert secrets.secret_spans(name, masked) == []


@pytest.mark.parametrize(("name", "value"), FREE)
def test_free(name, value):
    assert secrets.secret_spans(name, value) == []


def test_joined_literals_and_armor():
    value = f"var auth = '{RANDOM[:16]}' + '{RANDOM[16:]}';\n{KEY}"
    spans = secrets.secret_spans("code", value)
    assert len(spans) == 3 and secrets.redact(value, spans).endswith("-----END RSA PRIVATE KEY-----")


PATTERNS = ["ab+c", "(x|yz)=[0-9]{2}", "k[^a]?z", "a.c", "x[a-z]*=[0-9]"]


@settings(max_examples=150, deadline=None)
@given(st.text("abcxyzk=019é\n", max_size=300), st.integers(1, 64), st.integers(0, 9))
def test_automaton(text, chunk, reach):
    """Whatever the chunks and their overlap, and however long a match."""
    data = np.frombuffer(text.encode(), np.uint8)
    places, bits = Automaton(PATTERNS, reach=reach).scan(data, chunk)
    raw = text.encode()
    want = {}
    for k, p in enumerate(PATTERNS):
        whole = re.compile(p.encode(), re.S)
        for b in range(1, len(raw) + 1):
            if any(whole.fullmatch(raw, a, b) for a in range(b)):
                want[b] = want.get(b, 0) | 1 << k
    assert dict(zip(places.tolist(), bits.tolist())) == want


def test_operator(spark):
    long = "text " * 60_000 + f"api_key={RANDOM} " + "text " * 1000
    parameters = [{n + f"_{k}" if n not in ("db_pw", "password") else n: v} for k, (n, v, *_) in enumerate(HELD + FREE)] + [{"long": long, "none": None}, {}, None]
    nodes = [{"id": str(k), "name": None, "type": "t", "type_version": None, "parameters": p} for k, p in enumerate(parameters)]
    schema = "file_id long, nodes array<struct<id:string,name:string,type:string,type_version:double,parameters:map<string,string>>>, param string, masked int"
    files = spark.createDataFrame([(1, nodes, "c", 1), (1, nodes, "c", 1), (2, [None, nodes[0]], "c", 1), (3, [], "c", 1), (4, None, None, None)], schema)
    got = {tuple(r) for r in secrets.find_secrets(secrets.parameters(files)).select("file_id", "node_pos", "param").collect()}
    want = {(1, k, next(iter(p))) for k, p in enumerate(parameters[: len(HELD)])} | {(1, len(parameters) - 3, "long"), (2, 1, next(iter(parameters[0])))}
    assert got == want
    out = secrets.redact_files(files).collect()
    assert len(out) == 5 and out[0].asDict().keys() == {"file_id", "nodes", "param", "masked"}
    first = next(r for r in out if r["file_id"] == 1)
    assert first["nodes"][len(parameters) - 3]["parameters"]["long"] == long.replace(RANDOM, "<token-redacted>")
    assert [n["parameters"] for n in first["nodes"]][len(HELD) : len(HELD + FREE)] == parameters[len(HELD) : len(HELD + FREE)]
    assert secrets.find_secrets(secrets.parameters(files.limit(0))).count() == 0


PROSE = [
    ("note", "回模密码：K1Bga9i0Ke6PGW，步流库", "K1Bga9i0Ke6PGW"),
    ("note", "Password：Ya8tTrac0&aja5。", "Ya8tTrac0&aja5"),
    ("note", "密码是 doseni.BRANJU84，导", "doseni.BRANJU84"),
    ("content", "The login for liheto is leloho / salhazojo.KAVELU39 until friday", "salhazojo.KAVELU39"),
    ("content", "x.\nCredentials for the shop are me@a.example / Herabobi!4059.", "Herabobi!4059"),
    ("content", "La contraseña: Ab9xyz12kk, y nada", "Ab9xyz12kk"),
    ("content", "Das Kennwort: Ab9xyz12kk.", "Ab9xyz12kk"),
    ("密码", "Ab9xyz12kk", "Ab9xyz12kk"),
]
PLAIN = [
    ("note", "密码：请见 wiki"), ("note", "密码：********"), ("note", "密码：{{ $vars.abc1 }}"), ("content", "The login for a is at team / docs."),
    ("content", "The login for liheto is on https://a.example/b1C2d3e4"), ("content", "La clave: ninguna"),
]


def test_prose(spark):
    for name, value, secret in PROSE:
        spans = secrets.secret_spans(name, value)
        assert [value[a:b] for a, b, _ in spans] == [secret]
        assert secrets.redact(value, spans) == value.replace(secret, "<password-redacted>")
        assert secrets.secret_spans(name, secrets.redact(value, spans)) == []
    for name, value in PLAIN:
        assert secrets.secret_spans(name, value) == []
    rows = [(k, 0, n, v) for k, (n, v, *_) in enumerate(PROSE + PLAIN)]
    values = spark.createDataFrame(rows, "file_id long, node_pos int, param string, value string")
    assert {r["file_id"] for r in secrets.find_secrets(values).collect()} == set(range(len(PROSE)))


def test_place_never_matters():
    """A connection string with a long user, wherever it lies in the buffer, and a value of several chunks."""
    value = "https://" + "u" * 200 + ":aB3dE5fG7h@a.example/b"
    for before in range(0, 2200, 20):
        names, values = pa.array(["x", "url"]), pa.array(["y" * before, value])
        assert [(r, s) for r, _, s in secrets.spans_of(secrets.automaton(), names, values)] == [(1, [(209, 219, "password")])]
    long = "clave" + " " * 5000 + ": Ab9xyz12kk\n" + f"var k = '{RANDOM * 300}'; -----BEGIN {'VERY ' * 20}PRIVATE KEY-----" + "aB3x" * 2000
    assert [k for *_, k in secrets.secret_spans("code", long)] == ["password", "token", "private_key"]


def test_redacted_in_place(spark):
    """Ids that are null or come twice with other contents; all else stays as it was, byte for byte."""
    node = lambda p: {"id": None, "name": "n", "type": None, "type_version": 1.5, "parameters": p}
    secret, clean = {"note": f"密 api_key={RANDOM} é", "none": None}, {"note": "nothing here", "b": ""}
    schema = "file_id long, nodes array<struct<id:string,name:string,type:string,type_version:double,parameters:map<string,string>>>, n int"
    rows = [(None, [node(secret)], 0), (7, [node(secret), None, node(None)], 1), (7, [node(clean), node({})], 2), (8, [], 3), (9, None, 4)]
    frame = spark.createDataFrame(rows, schema)
    out = secrets.redact_files(frame)
    assert out.schema == frame.schema and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["n"]: r for r in out.collect()}
    masked = secret | {"note": "密 api_key=<token-redacted> é"}
    want = {0: [node(masked)], 1: [node(masked), None, node(None)], 2: [node(clean), node({})], 3: [], 4: None}
    assert {n: r.asDict(recursive=True)["nodes"] for n, r in got.items()} == want and got[0]["file_id"] is None
    assert secrets.redact_files(frame.limit(0)).count() == 0 and secrets.redact_files(out).collect() == out.collect()
