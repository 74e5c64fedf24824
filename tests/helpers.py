"""What several test files share; a name that no other folder of tests uses."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))
