"""A made-up site for whole builds: terraces, a dome, a solid deck on posts and a mast; and a counter that needs no engine."""

import itertools
import math

import numpy as np

EAST, NORTH, EPSG = 500000.0, 7500000.0, 31983
NX, NY = 130, 110


def columns():
    """(east cell, north cell, height cells, colour) of each part of the site."""
    for i, j in itertools.product(range(NX), range(NY)):
        terrace = 1 + 3 * ((i // 13 + j // 11) % 5)
        reach = 400 - (i - 90) ** 2 - (j - 60) ** 2
        top = max(terrace, 2 + math.isqrt(reach)) if reach > 0 else terrace
        yield i, j, [top], (60 + 9 * top, 200 - 4 * top, 40 + (i ^ j) % 64)
    for i, j in itertools.product(range(40, 70), range(20, 34)):
        yield i, j, range(30, 34), (150, 150, 30 + 2 * (i - 40))
    for i, j in ((40, 20), (69, 20), (40, 33), (69, 33)):
        yield i, j, range(16, 30), (90, 90, 90)
    yield 20, 100, range(14, 45), (250, 10, 10)


def points():
    """Integer millimetres [n, 3] from (EAST, NORTH, 0) and 16-bit colours [n, 3]; one stake fixes the corner of the grid."""
    rows = [(100, 1000 * (NY - 1) + 900, 100, 0, 0, 0)]
    for i, j, heights, rgb in columns():
        for k in heights:
            for n in range(1 + (i + j + k) % 3):
                rows.append((1000 * i + 350 + 90 * n, 1000 * j + 620 - 80 * n, 1000 * k + 400 + 60 * n, *rgb))
    a = np.array(rows)
    return a[:, :3], a[:, 3:] * 256


def count(brick):
    """Grid, voxels and, from the coarsest level on, (tiles, drawn cubes, faces) by sets of cells."""
    cells = {(0, 0, 0)} | {(i, k, NY - 1 - j) for i, j, heights, _ in columns() for k in heights}
    dims = tuple(max(c[a] for c in cells) + 1 for a in range(3))
    voxels, levels = len(cells), []
    while True:
        open_sides = {(x, y, z): sum((x + a, y + b, z + c) not in cells for a, b, c in ((1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))) for x, y, z in cells}
        drawn = {c: n for c, n in open_sides.items() if n}
        levels.insert(0, (len({(x // brick, z // brick) for x, _, z in drawn}), len(drawn), sum(drawn.values())))
        if max(-(-d // 2 ** (len(levels) - 1)) for d in (dims[0], dims[2])) <= brick:
            return dims, voxels, levels
        cells = {(x // 2, y // 2, z // 2) for x, y, z in cells}
