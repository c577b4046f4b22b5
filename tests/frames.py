"""What tests read out of DataFrames."""


def rows(df, *columns):
    """All rows as sorted tuples, columns in name order unless given."""
    found = df.select(*(columns or sorted(df.columns))).collect()
    return sorted([tuple(row) for row in found], key=lambda row: tuple((v is None, str(v)) for v in row))
