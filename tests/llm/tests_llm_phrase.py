"""Deterministic texts for the tests of this folder."""
WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi "
         "psi omega").split()


def phrase(seed: int, n: int) -> str:
    """Words that depend on the seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x >> 8 & 15] + WORDS[x >> 16 & 15])
    return " ".join(out)
