"""Small graphs whose numbers are common knowledge."""

from itertools import combinations

# The friendships in Zachary's karate club, by member.
KARATE = {
    1: [2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14, 18, 20, 22, 32],
    2: [3, 4, 8, 14, 18, 20, 22, 31],
    3: [4, 8, 9, 10, 14, 28, 29, 33],
    4: [8, 13, 14], 5: [7, 11], 6: [7, 11, 17], 7: [17], 9: [31, 33, 34], 10: [34], 14: [34],
    15: [33, 34], 16: [33, 34], 19: [33, 34], 20: [34], 21: [33, 34], 23: [33, 34],
    24: [26, 28, 30, 33, 34], 25: [26, 28, 32], 26: [32], 27: [30, 34], 28: [34], 29: [32, 34],
    30: [33, 34], 31: [33, 34], 32: [33, 34], 33: [34],
}
PETERSEN = [(i, (i + 1) % 5) for i in range(5)] + [(i, i + 5) for i in range(5)] + [(5 + i, 5 + (i + 2) % 5) for i in range(5)]

# Edges, vertices, largest degree, triangles, mean local clustering.
KNOWN = {
    "karate": ([(a, b) for a, row in KARATE.items() for b in row], 34, 17, 45, 0.5706384782),
    "petersen": (PETERSEN, 10, 3, 0, 0.0),
    "complete": (list(combinations(range(7), 2)), 7, 6, 35, 1.0),
    "star": ([(0, i) for i in range(1, 9)], 9, 8, 0, 0.0),
    "wheel": ([(0, i) for i in range(1, 6)] + [(i, i % 5 + 1) for i in range(1, 6)], 6, 5, 5, (5 * 2 / 3 + 0.5) / 6),
}
