"""Small literal frames."""

import datetime as dt


def at(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
