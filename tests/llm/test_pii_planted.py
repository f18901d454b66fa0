"""Loose personal data planted by templates that training does not have, among look-alikes."""

import random

from devicelens.llm import pii
from test_llm_operators import sentence

NAMES = ["alice.k", "b_smith", "info", "j-doe77", "sales.team"]
HOSTS = [("acme", "com"), ("mail.uni", "edu"), ("shop-24", "de"), ("kraft", "co.uk"), ("north", "io")]


def planted(rng):
    """(kind or None, text before, span, text after)."""
    d = lambda n: str(rng.randint(10 ** (n - 1), 10 ** n - 1))
    (host, tld), name = rng.choice(HOSTS), rng.choice(NAMES)
    spelt = lambda at, dot: name + at + host.replace(".", dot) + dot + tld.replace(".", dot)
    octet = lambda: str(rng.randint(0, 255))

    def card(by):
        body = "4" + d(14)
        total = sum((2 * int(c) - 9 if 2 * int(c) > 9 else 2 * int(c)) if i % 2 == 0 else int(c) for i, c in enumerate(body))
        number = body + str(-total % 10)
        return by.join(number[k:k + 4] for k in range(0, 16, 4))

    good = [("email", "you may ask ", spelt(" [at] ", " [dot] "), ", who knows"), ("email", "send it to ", spelt("(at)", "."), " today"),
            ("email", "owner: ", spelt(" at ", " dot "), " thanks"), ("email", "e-mail ", spelt(" AT ", " DOT "), ""),
            ("phone", "my tel is ", f"0{d(3)}/{d(7)}", " all day"), ("phone", "fax ", f"{d(3)} {d(3)} {d(4)}", "."), ("phone", "text or call ", f"{d(3)}-{d(3)}-{d(4)}", " now"),
            ("phone", "cell phone ", f"({d(3)}) {d(3)}-{d(4)}", " or"), ("phone", "phone ", f"00{d(2)}-{d(2)}-{d(7)}", " ext"), ("phone", "mobile: ", d(10), " please"),
            ("ip", "the server at ip ", "[.]".join(octet() for _ in range(4)), " is down"), ("ip", "on host ", "(.)".join(octet() for _ in range(4)), " again"),
            ("card", "my visa ", card("."), " expires"), ("card", "credit card ", card("/"), " was")]
    bad = [("dated ", f"{rng.randint(1950, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", ""), ("on ", f"{rng.randint(10, 28)}.{rng.randint(10, 12)}.{rng.randint(1950, 2030)}", " we"),
           ("years ", f"{rng.randint(1950, 1990)}-{rng.randint(1991, 2030)}", " were"), ("order ", d(10), " shipped"), ("invoice no ", f"{d(4)}-{d(5)}", " due"),
           ("isbn ", f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}", " in print"), ("serial ", f"{d(4)}.{d(4)}.{d(3)}", " on it"), ("hash a", d(12), "f end"),
           ("look at ", f"the {sentence(1)} dot matrix", " there"), ("sum ", f"{d(4)} / {d(4)}", " of"), ("build ", f"{d(1)}.{d(2)}.{d(5)}.{d(2)}.1", " broke"), ("part no. ", d(9), " fits")]
    return rng.choice(good) if rng.random() < 0.5 else (None, *rng.choice(bad))


def test_planted_personal_data(spark):
    rng, texts, want = random.Random(31), [], {}
    for i in range(1200):
        kind, before, span, after = planted(rng)
        head = f"{sentence(4)}. {before}"
        texts.append((i, f"{head}{span}{after} {sentence(4)}"))
        want[i] = {(kind, len(head), len(head) + len(span))} if kind else set()
    found = {r.doc_id: ({(pii.KINDS[s[0]], s[1], s[2]) for s in r.base}, {(pii.KINDS[s[0]], s[1], s[2]) for s in r.added})
             for r in pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    base, added = ({i: f[k] for i, f in found.items()} for k in (0, 1))
    real = [i for i in want if want[i] and want[i] != base[i]]
    caught = [i for i in real if added[i] & want[i]]
    wrong = [i for i in want if added[i] - want[i]]
    missed = sorted({texts[i][1][len(texts[i][1]) // 3:][:60] for i in set(real) - set(caught)})
    print(f"planted {len(real)}, caught {len(caught)}, texts with a wrong span {len(wrong)} of {len(want)}")
    assert len(caught) >= 0.9 * len(real), (len(caught), len(real), missed[:12])
    assert len(caught) >= 0.9 * (len(caught) + len(wrong)), [(texts[i][1], added[i]) for i in wrong[:12]]
