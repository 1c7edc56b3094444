"""The small labelled table of URLs that the URL filter learns from, made from two kinds of words."""

from __future__ import annotations

#: What unwanted hosts are about and the words beside it; what others are about and the words beside that.
UNWANTED, LURES = "casino poker pills pharma adult xxx spam bets betting ads clicks payday replica warez torrent".split(), "bonus online free best cheap mail cams win videos track cash farm sport deals zone x loans club top".split()
SUBJECTS, PLACES = "news library museum university garden weather kitchen history science theatre orchestra hospital railway school chemistry novels poetry bakery recipes travel physics".split(), "archive village harbour forest council journal centre guide".split()


def pairs(first: list[str], second: list[str], each: int) -> list[str]:
    """Each word with `each` of the others, by turns before and after them; no pair is made for a host that is to be judged."""
    return [f"{a}-{b}" if k % 2 else f"{b}-{a}" for i, a in enumerate(first) for k in range(each) for b in [second[(i + 2 * k) % len(second)]]]


PREFIXES, ENDS = ("", "www.", "blog.", "m."), ("com", "net", "org")
PATHS = ("/en/{}", "/fr/{}.html", "/de/{}/", "/es/{}", "/articles/{}", "/")


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 for block): every name with two prefixes and ends; paths carry no signal."""
    out = []
    for label, words in ((1, pairs(UNWANTED, LURES, 7)), (0, [*SUBJECTS, *pairs(SUBJECTS, PLACES, 3), *syllable_hosts()])):
        for i, w in enumerate(words):
            for j in (0, 1):
                k = 2 * i + j
                host = f"{PREFIXES[(k + j) % 4]}{w}.{'example.' * (k % 3 != 2)}{ENDS[k % 3 if j else (k + 1) % 3]}"
                out.append((f"https://{host}{PATHS[(i + 3 * j) % len(PATHS)].format(37 * k % 997)}", label))
    return out


def syllable_hosts() -> list[str]:
    """Harmless invented names, so that unknown names without a marked word lean to allow."""
    first, second = "ran tol mer bel ster nor val hin thon lan dor ver the sha whe ent ons rea".split(), "ing tion ber ley mond sted her ton and eth ist out".split()
    return [a + second[(3 * i + k) % len(second)] for i, a in enumerate(first) for k in range(6)]
