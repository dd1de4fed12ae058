"""A small labelled table for the personal-data tagger: token sequences with one label per token.

Sentences are frames with places for values; values are made by rule from a fixed seed, both in the
forms that the base patterns match and in others (local phone numbers, addresses with a spelled-out
at sign, IPv6). Frames without places teach which numbers and words are not personal data.
"""

from __future__ import annotations

import random

LABELS = ("O", "email", "ip", "card", "phone")
SEED = 7
COPIES = 6  # times each frame is filled

FRAMES = (
    "{w} {w} write to {email} for {w} .",
    "{w} {email} {w} {w}",
    "Contact : {email} , {w} or {phone}",
    "{W} {w} {email} . {W} {w}",
    "call {phone} {w} {w}",
    "{w} {w} , {w} {phone} {w} . {W}",
    "{phone} {w} {w} {w}",
    "Tel. {phone} {w}",
    "{w} host {ip} {w} {w}",
    "{w} , {ip} {w} {w} .",
    "{ip} {w} {W} {w}",
    "{w} {w} {card} {w} {w}",
    "card {card} {w} .",
    "{card} {w} {W} {w}",
    "{W} {w} , {card} {w} {ip} {w}",
    "{w} {email} {w} {card} {w} {phone}",
    "{W} {w} {w} {w} .",
    "{w} {w} , {w} {w} {w} {W} {w} .",
    "{W} {w} {number} {w} {w}",
    "{w} version {version} , {w}",
    "{w} {w} in {year} {w} {w} .",
    "{w} {hex} {w} {w}",
    'token = "{hex}" {w} {w}',
    "{w} | {w} | {w} | {W}",
    "{W}!! {W}!! {w}&&& {w}### {w}%%% {w}$$$",
    "{w} {price} {w} {w} , {number} {w} .",
    "{w} @ {w} {w}",
    "{w}.{w} {w} + {w} - {w}",
    "{w} ( {w} ) {w} {number}.",
    "{W} {w} {number}-{number} {w} {w}",
    "{w} {number}:{number} {w} {date} {w}",
)


def word(rng: random.Random) -> str:
    return "".join(rng.choice(("an", "the", "ei", "qu", "ó", "re", "st", "on", "ü", "ti")) for _ in range(rng.randint(1, 5)))


def digits(rng: random.Random, n: int) -> str:
    return "".join(str(rng.randint(0, 9)) for _ in range(n))


def value(kind: str, rng: random.Random) -> str:
    """A value of one kind; its tokens all get the kind's label."""
    a, b = word(rng).encode("ascii", "ignore").decode() or "ab", "mail" + str(rng.randint(1, 9))
    four = lambda: digits(rng, 4)
    byte = lambda: str(rng.randint(0, 255))
    forms = {
        "email": (f"{a}.{four()[:2]}@{b}.example.com", f"{a}@{b}.org", f"{a}_{b}(at){b}.example.com", f"{a}[at]{b}.net"),
        "ip": (".".join(byte() for _ in range(4)), ":".join(digits(rng, 3) + "f" for _ in range(8)), "2001:db8::" + four()),
        "card": (digits(rng, 16), " ".join(four() for _ in range(4)), "-".join(four() for _ in range(4))),
        "phone": (
            f"+1 ({digits(rng, 3)}) 555-{four()}",
            f"+{digits(rng, 2)} {digits(rng, 3)} {digits(rng, 7)}",
            f"({digits(rng, 3)}) 555-{four()}",
            f"{digits(rng, 3)}-555-{four()}",
        ),
    }
    return rng.choice(forms[kind])


def neutral(kind: str, rng: random.Random) -> str:
    return {
        "w": word(rng),
        "W": word(rng).capitalize() if rng.random() < 0.8 else word(rng).upper(),
        "number": digits(rng, rng.randint(1, 6)),
        "version": f"{rng.randint(1, 9)}.{rng.randint(0, 9)}",
        "year": str(rng.randint(1900, 2030)),
        "hex": "".join(rng.choice("0123456789abcdef") for _ in range(40)),
        "price": f"{digits(rng, 2)}.{digits(rng, 2)}",
        "date": f"{digits(rng, 2)}/{digits(rng, 2)}/{digits(rng, 4)}",
    }[kind]


def labelled() -> list[list[tuple[str, str]]]:
    """The labelled table: sequences of (token, label)."""
    rng, out = random.Random(SEED), []
    for frame in FRAMES * COPIES:
        row: list[tuple[str, str]] = []
        for part in frame.split(" "):
            label = next((kind for kind in LABELS[1:] if "{" + kind + "}" in part), "O")
            while "{" in part:
                kind = part[part.index("{") + 1 : part.index("}")]
                filled = value(kind, rng) if kind in LABELS else neutral(kind, rng)
                part = part.replace("{" + kind + "}", filled, 1)
            ending = rng.choice(("", "", ",", ".")) if label != "O" else ""
            row += [(token, label) for token in (part + ending).split()]
        out.append(row)
    return out
