import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from igarape.session import build_session  # noqa: E402

MUNICIPALITIES = """name,ibge_code,uf,is_rmb
Belém,1501402,PA,1
Ananindeua,1500800,PA,1
Marituba,1504422,PA,1
Benevides,1501501,PA,1
Santa Bárbara do Pará,1506351,PA,1
Santa Izabel do Pará,1506500,PA,1
Castanhal,1502400,PA,1
Barcarena,1501303,PA,1
Outra Cidade,1509999,PA,0
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        master="local[8]",
        **{
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def municipalities(spark, tmp_path_factory):
    from igarape.sources.dimension import read_municipalities

    path = tmp_path_factory.mktemp("dimension") / "municipalities.csv"
    path.write_text(MUNICIPALITIES, encoding="utf-8")
    return read_municipalities(spark, str(path))


@pytest.fixture(scope="session")
def dimension(municipalities):
    from igarape.sources.dimension import municipality_dimension

    return municipality_dimension(municipalities)
