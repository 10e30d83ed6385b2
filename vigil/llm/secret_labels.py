"""Labelled findings for the secret scanner, made by rule from a seed.

Each finding is (words before, candidate, words after, label): label 1 for
random credentials and passwords in the places where they occur, label 0 for what looks alike
but is none (numbers, checksums, identifiers, file names, placeholders, words).
"""

from __future__ import annotations

import random

_HEX, _LOW, _UP, _DIG = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_MIX = _LOW + _UP + _DIG
_NAMES = ("token", "api_key", "secret", "password", "access_token", "auth", "client_secret", "private_key", "TOKEN", "API_KEY", "SECRET_KEY", "passwd", "apikey", "credential", "bearer")
_IDLE = ("the", "of", "and", "one", "result", "was", "in", "de", "und", "que", "la", "with", "some", "on", "shown", "as", "line", "page")
_NOT = ("commit", "sha1", "checksum", "md5", "hash", "build", "revision", "uuid", "card", "phone", "order", "isbn", "account", "version", "id", "file", "image", "see")
_WORDS = ("your", "example", "token", "here", "test", "sample", "key", "change", "this", "value", "default", "user", "data", "image", "index", "version", "release", "summer", "report", "final")
_SIGNS = "!@$%^&*#:?"
_SCHEMES = ("postgres", "mysql", "mongodb+srv", "https", "redis", "amqp", "ftp")
_IDLE_VALUES = ("true", "false", "null", "none", "required", "optional", "string", "basic", "bearer", "enabled", "disabled", "changeme", "password", "example", "secret", "undefined", "empty", "login")


def findings(n: int = 1800, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """n findings, half of either label."""
    r = random.Random(seed)
    word = lambda pool: r.choice(pool)
    text = lambda pool, k: "".join(r.choice(pool) for _ in range(k))
    idle = lambda k: " ".join(word(_IDLE) for _ in range(k))
    out = []
    for k in range(n):
        after = idle(1)
        if k % 2:
            kind = r.randrange(10)
            cand = (text(_HEX, r.choice((32, 40, 64))), text(_MIX, r.randint(20, 48)), "AKIA" + text(r.choice((_UP, _UP + _DIG)), 16), "ghp_" + text(_MIX, 36),
                    text(_MIX + "+/", r.choice((40, 44, 86))), text(_HEX, 40),
                    text(_MIX + _SIGNS, r.randint(6, 24)), text(r.choice((_LOW + _UP, _LOW + _UP, _UP, _LOW)), r.randint(16, 40)), text(_MIX, r.randint(7, 15)),
                    word(_WORDS).capitalize() + text(_DIG, r.randint(1, 4)) + text(_SIGNS, r.randint(1, 2)))[kind]
            if kind == 5 and r.random() < 0.5:
                cand = cand.upper()
            mark = r.choice((" = ", " = ", ": ", "=", " ")) if kind < 6 else r.choice((" = ", ": ", "="))
            before = f"{idle(1)} {word(_NAMES)}{mark}{r.choice(('', chr(34), chr(34), chr(39)))}"
            if kind in (2, 3) and r.random() < 0.4:
                before = idle(3) + " "
            if kind in (6, 8, 9) and r.random() < 0.4:
                before = f"{idle(2)} {word(_SCHEMES)}://{word(_WORDS)}:"
            out.append((before, cand, after, 1))
        else:
            kind = r.randrange(14)
            cand = (text(_DIG, 16), text(_DIG, r.randint(16, 22)), text(_HEX, 40), "-".join(text(_HEX, m) for m in (8, 4, 4, 4, 12)),
                    "-".join(word(_WORDS) for _ in range(r.randint(3, 5))) + str(r.randint(1, 99)), "_".join(word(_WORDS) for _ in range(r.randint(2, 4))) + "_" + text(_DIG, r.randint(2, 4)),
                    text(_LOW, r.randint(15, 24)) + text(_DIG, 1), "/".join(word(_WORDS) for _ in range(3)) + f"/{r.randint(1, 99)}.html", text("x", r.randint(16, 32)) + "1",
                    text(r.choice((_LOW, _UP)), r.randint(15, 24)) + r.choice(("", ".")), "-".join(text(_LOW, r.randint(3, 9)) for _ in range(r.randint(3, 5))), "".join(text(_LOW, r.randint(3, 8)).capitalize() for _ in range(r.randint(3, 5))),
                    word(_IDLE_VALUES), r.choice(("${" + word(_NAMES).upper() + "}", f"<{word(_WORDS)}-{word(_WORDS)}>", f"get{word(_WORDS).capitalize()}()", f"os.environ[{word(_NAMES)}]", "*" * r.randint(4, 12), text("x", r.randint(4, 12)))))[kind]
            before = f"{idle(2)} {word(_IDLE)} "
            if kind in (2, 3):
                before = f"{idle(1)} {word(_NOT)}{r.choice((' ', ': ', ' = '))}"
            elif kind in (12, 13) and r.random() < 0.2:
                before = f"{idle(2)} {word(_SCHEMES)}://{word(_WORDS)}:"
            elif kind in (12, 13):
                before = f"{idle(1)} {word(_NAMES)}{r.choice((' = ', ': ', '='))}{r.choice(('', chr(34), chr(39)))}"
            elif kind in (4, 5, 8) and r.random() < 0.5:
                before = f"{idle(1)} {word(_NAMES)} = {chr(34)}"
            out.append((before, cand, after, 0))
    return out
