"""Plain helpers of these tests (a conftest of the same name as another cannot be imported)."""


def prose(n, seed=0):
    """n different words, reproducible."""
    return " ".join(f"word{seed}x{k}" for k in range(n))
