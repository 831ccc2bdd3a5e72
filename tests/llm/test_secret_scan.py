import base64
import hashlib
import json
import random
import re

from cargolens.llm.secret_scan import (confirmed_spans, decoded, is_der_key, is_ssh_key, listed,
                                       secret_report)

from .helpers import DOCS, corpus


def der(tag, content):
    size = len(content)
    head = bytes([size]) if size < 128 else bytes([128 + (size.bit_length() + 7) // 8]) + size.to_bytes(
        (size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + content


def number(value):
    return der(2, value.to_bytes(value.bit_length() // 8 + 1, "big"))


def rsa_key(seed, bits=512):
    rng = random.Random(seed)
    return der(48, number(0) + b"".join(number(rng.getrandbits(bits) | 1) for _ in range(8)))


def pkcs8(seed):
    return der(48, number(0) + der(48, der(6, bytes.fromhex("2a864886f70d010101")) + der(5, b""))
               + der(4, rsa_key(seed)))


def wire(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


def b64(data, url=False):
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def token(header):
    return ".".join([b64(json.dumps(header).encode(), True), b64(b'{"sub":"1"}', True),
                     b64(bytes(range(32)), True)])


def pem(data, kind="PRIVATE KEY"):
    body = b64(data)
    lines = "\n".join(body[k:k + 64] for k in range(0, len(body), 64))
    return f"-----BEGIN {kind}-----\n{lines}\n-----END {kind}-----"


def kinds(text):
    return [s.split(":")[0] for s in listed(confirmed_spans(text)).split(",") if s]


def test_structures_are_confirmed_and_lookalikes_are_not():
    rsa, ssh = rsa_key(1), wire(b"ssh-ed25519", bytes(32))
    opened = b"openssh-key-v1\x00" + wire(b"none", b"none", b"") + (1).to_bytes(4, "big") + wire(ssh, b"x" * 90)
    assert is_der_key(rsa) and is_der_key(pkcs8(2)) and is_ssh_key(ssh) and is_ssh_key(opened)
    assert kinds(f"key {b64(rsa)} end") == ["der"] and kinds(f"k {rsa.hex()} e") == ["der"]
    assert kinds("ssh-ed25519 " + b64(ssh)) == ["ssh"]
    assert kinds(pem(pkcs8(3)))[:1] == ["pem"] and "pem" in kinds(pem(opened, "OPENSSH PRIVATE KEY"))
    assert kinds("a " + token({"alg": "HS256", "typ": "JWT"})) == ["jwt"]
    for changed in (rsa[:-1], rsa + b"\x00", rsa[:1] + bytes([rsa[1], rsa[2], rsa[3] ^ 1]) + rsa[4:]):
        assert not is_der_key(changed)
    assert not kinds("a " + token({"typ": "JWT"})) and not kinds("eyJub3QganNvbg.AAAA.BBBB")
    assert not kinds(pem(bytes(range(1, 99)))) and not kinds("M" * 64) and not kinds("30" * 40)
    assert not kinds("x" * 100_000) and not kinds("plain " * 1000)
    assert decoded("AAAAA") is None and decoded("QQ==") == b"A" and decoded("QR==") is None


def base(text):
    """The plain patterns as they are written, one search for each."""
    spans = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""\
        r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for place, (kind, pattern, group, least) in enumerate((
            ("assign", assign, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))):
        spans += [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text)
                  if len(m[group]) >= least]
    return [s for _, _, s in sorted(spans)]


def check(docs, texts):
    for row in secret_report(docs).collect():
        want = base(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(
            sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(want) <= set(spans) and len(spans) == len(want) + row["n_confirmed"]


def test_plain_spans_equal_brute_force(spark):
    rng = random.Random(9)
    bits = ["password", "Token", "apiKey", "api_key", "SECRET", "ſecret", "=", ":", " ", '"', "'", "AKIA",
            "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "x", "é𝄞", "\n", "K", "tokentoken="]
    texts = [None, "", "token=" + "a" * 300_000, pem(rsa_key(4)), "api_key: " + token({"alg": "none"})]
    texts += ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(600)]
    check(corpus(spark, texts).repartition(4), texts)
    assert secret_report(spark.createDataFrame([], DOCS)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, {r["doc_id"]: r["text"] for r in docs.collect()})


def test_encrypted_keys_header_lines_and_spaced_token_headers():
    pbes = der(48, der(6, bytes.fromhex("2a864886f70d01050d")) + der(48, der(4, bytes(8)) + number(2048)))
    locked = der(48, pbes + der(4, bytes(range(160))))
    digest = der(48, der(48, der(6, bytes.fromhex("608648016503040201")) + der(5, b"")) + der(4, bytes(32)))
    assert is_der_key(locked) and not is_der_key(digest) and not is_der_key(der(48, pbes + der(4, b"")))
    assert "pem" in kinds(pem(locked, "ENCRYPTED PRIVATE KEY"))

    def with_lines(data, *lines):
        return pem(data, "RSA PRIVATE KEY").replace("KEY-----\n", "KEY-----\n" + "\n".join(lines) + "\n\n", 1)

    proc, noise = "Proc-Type: 4,ENCRYPTED", bytes(k * 37 % 256 for k in range(160))
    block = with_lines(noise, proc, "DEK-Info: AES-128-CBC," + "8D" * 16)
    for text in (block, block.replace("\n", "\r\n"), block.replace("\n", "\\n"), block.replace("\n", "\n    "),
                 with_lines(noise, proc, "DEK-Info: DES-EDE3-CBC," + "0a" * 8),
                 with_lines(rsa_key(5), "Comment: my-own key, old")):
        assert kinds("x " + text) == ["pem"] and confirmed_spans("x " + text)[0][2] == len(text) + 2
    for text in (with_lines(noise, proc), with_lines(noise, "Comment: none"), with_lines(noise, proc, "DEK-Info: AES-128-CBC,8D"),
                 with_lines(noise[:-3], proc, "DEK-Info: AES-128-CBC," + "8D" * 16), pem(noise)):
        assert not kinds(text)
    assert not kinds("-----BEGIN PRIVATE KEY-----a: b\n" * 20_000)
    for header in (b'{ "alg":"HS256"}', b'{\n  "alg": "HS256"\n}', b' {"alg":"HS256"}', b'\r\n{"alg":"HS256"}', b'\t{"alg":"X"}'):
        text = b64(header, True) + token({"alg": "x"})[len(b64(b'{"alg": "x"}', True)):]
        assert kinds("a " + text) == ["jwt"]
    assert not kinds("Dogs.are.nice example.com.au I.am.here")
