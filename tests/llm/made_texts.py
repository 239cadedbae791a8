"""Made-up texts."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau".split()


def sentence(seed: int, n: int) -> str:
    """``n`` words, different for each seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 12) % len(WORDS)] + WORDS[(x >> 20) % len(WORDS)])
    return " ".join(out)
