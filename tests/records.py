"""Generated connection records for the tests."""

import random

from alertloom.params import CATEGORICAL, RAW_COLUMNS

TYPES = ["normal", "neptune", "smurf", "satan", "nmap", "imap", "phf", "perl", "xterm"]


def record_rows(n=200, seed=1, unmapped=("mystery_a", "mystery_b"), nulls=True, service=None):
    """Rows as tuples in the raw layout; two unmapped types, a constant column, nulls in two columns."""
    rng = random.Random(seed)
    kinds = [*TYPES, *unmapped]
    rows = []
    for i in range(n):
        row = []
        for name, dtype in RAW_COLUMNS:
            if name == "attack_type":
                value = kinds[i % len(kinds)]
            elif name == "service":
                value = service or rng.choice(["http", "http", "smtp", "ftp"])
            elif name in CATEGORICAL:
                value = rng.choice(["a", "b", "b", "b"])
            elif name == "num_outbound_cmds":
                value = 0
            elif dtype == "double":
                value = rng.randint(0, 100) / 100
            else:
                value = rng.randint(0, 500)
            if nulls and name in ("src_bytes", "same_srv_rate") and i % 25 == 3:
                value = None
            row.append(value)
        rows.append(tuple(row))
    return rows


def write_csv(path, rows):
    with open(path, "w") as f:
        for row in rows:
            f.write(",".join("" if v is None else str(v) for v in row) + "\n")
    return str(path)
