DATA = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def long_text(n: int, salt: int = 0) -> str:
    return " ".join(f"{WORDS[(i * 7 + salt) % 24]}{(i * i + salt) % 97}" for i in range(n))
