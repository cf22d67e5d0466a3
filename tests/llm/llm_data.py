"""Made-up texts for the tests."""

import random

WORDS = "the of and to in is that for it was on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()

#: Columns that clash with names of results.
EXTRA = "keep_id long, kept string, group_size int, text_sha256 string, score double, class_id long, start int, length string, labels string, n_words int, pid int, row string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))
