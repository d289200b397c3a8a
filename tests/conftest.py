import pytest

from civicpanel.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "civicpanel-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(rows, schema)`` makes a small frame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def municipio(frame):
    """Municipality master with homonyms, an accent, and a missing centroid."""
    return frame(
        [
            ("5208707", "Goiânia", "52", "GO", "Goiás", "Centro-Oeste", 1, "POINT(-49.25 -16.68)"),
            ("5200050", "Bom Jesus", "52", "GO", "Goiás", "Centro-Oeste", 0, "POINT(-48.5 -16.5)"),
            ("4302303", "Bom Jesus", "43", "RS", "Rio Grande do Sul", "Sul", 0, None),
            ("4314902", "Porto Alegre", "43", "RS", "Rio Grande do Sul", "Sul", 1, "POINT(-51.2 -30.0)"),
        ],
        "id_municipio string, nome string, id_uf string, sigla_uf string, nome_uf string, "
        "nome_regiao string, capital_uf int, centroide string",
    )


def rows(df, *columns):
    """Collected rows as tuples, sorted, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=lambda r: [(v is not None, str(v)) for v in r])
