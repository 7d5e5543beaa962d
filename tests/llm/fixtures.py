"""Small tables with everything that operators must stand: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

TEXT = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "Ünder", "漢字", "naïve"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def documents() -> list[tuple]:
    passage = prose(99, 60)
    base = prose(1, 200)
    near = base.replace(base.split()[50], "changed")
    texts = {
        1: base, 2: base, 3: near, 4: f"{prose(2, 80)} {passage} {prose(3, 30)}", 5: f"{prose(4, 20)}\n{passage}\n{prose(5, 90)}", 6: None, 7: "", 8: " \t\n ", 9: "one", 10: "one", 11: "two words",
        12: prose(6, 6000), 13: "a" * 3000, 14: "ab " * 900, 15: "é" * 450, 16: passage, 17: "<|im_end|> [INST] x", 18: prose(7, 400),
    }
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in texts.items()]
    return [*rows, rows[3], (None, prose(8, 90), None, None, None), (18, prose(9, 50), "de", "s1", 7)]
