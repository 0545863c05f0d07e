"""Weak supervision: the reliability of labelers, estimated from how their votes agree."""

import math

# Before any evidence: how likely a vote is on a positive item; on a negative one, votes change places.
PRIOR_VOTES = {1: 0.45, 0: 0.5, -1: 0.05}
PRIOR_WORTH = 0.1       # weight of that, in items


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], silence_tells: bool, rounds: int = 200
             ) -> tuple[list[float], dict[str, dict[int, tuple[float, float]]], float]:
    """Expectation-maximisation over vote patterns (1, -1, 0: abstains) and their counts.

    Votes are independent given the truth. Vote probabilities have a prior, worth
    a tenth of the items, by which a labeler is better than chance unless the
    others contradict it. ``silence_tells``: whether an abstention is evidence
    like a vote (labelers that look for one thing) or says nothing (labelers that
    often cannot tell). Returns the posterior of each pattern, each labeler's
    probabilities of each vote on positive and negative items, and the share of
    positive items. The number of patterns is bounded by the number of labelers,
    whatever the data.
    """
    total = sum(n for _, n in patterns)
    posterior = [0.9 if sum(votes) > 0 and min(votes) >= 0 else 0.5 if sum(votes) > 0 else 0.1 for votes, _ in patterns]
    said, prior = {}, 0.5
    kinds = (1, 0, -1) if silence_tells else (1, -1)
    for _ in range(rounds):
        prior = (sum(p * n for p, (_, n) in zip(posterior, patterns)) + 1) / (total + 2)
        for k, name in enumerate(names):
            worth = 1 + PRIOR_WORTH * sum(n for votes, n in patterns if votes[k] in kinds)
            sides = []
            for sign in (1, -1):
                weight = {v: sum((p if sign > 0 else 1 - p) * n for p, (votes, n) in zip(posterior, patterns) if votes[k] == v) for v in kinds}
                expected = {v: PRIOR_VOTES[sign * v] / sum(PRIOR_VOTES[u] for u in kinds) for v in kinds}
                sides.append({v: (weight[v] + worth * expected[v]) / (sum(weight.values()) + worth) for v in kinds})
            said[name] = {v: (sides[0][v], sides[1][v]) for v in kinds}
        new = []
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(said[name][v][0] / said[name][v][1]) for name, v in zip(names, votes) if v in kinds)
            new.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
        done = max(map(abs, (a - b for a, b in zip(new, posterior))), default=0.0) < 1e-9
        posterior = new
        if done:
            break
    return posterior, said, prior
