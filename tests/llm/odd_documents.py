"""Texts with all that is odd."""

import random


def odd_texts():
    """Nulls, empty and blank texts, ties, exact and near copies, shared passages and lines, odd characters, one long text."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)] + ["é́t", "naïve", "ẞ", "漢字", "😀", "The", "of"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(60), "A line that a good many documents hold, here and there  "
    base = text(300)
    out = [None, "", " \t\n ", "one", "two words", "same", "same", "same", text(35), text(34)]
    for i in range(6):
        out += [f"{text(40)}\n{line}\n{text(20)}", f"{text(30)} {passage} {text(25)}", f"{line.upper()}\n{text(60)}"]
        out.append(" ".join(base.split()[: 290 + i]))
        out.append(base.replace(" w1", f" v{i}", 1))
    out += [base, base, text(80) + "\n" + "again and again and again. " * 60, "x" * 9000, text(20_000), "tab\tsep\vand\x0cfeed\r\nend", " nbsp em\u0085nel"]
    out += [passage, "\n".join([line] * 7), text(90) + " " + text(5) * 3]
    return out
