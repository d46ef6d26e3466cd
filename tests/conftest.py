import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from jobgrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared_folder}
    session = local_session("8", "jobgrain-tests", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_lexicon(spark):
    rows = [
        ("Python", "Technical", "Language", "python,py"),
        ("Machine Learning", "Technical", "Modelling", "ml, machine learning"),
        ("SQL", "Technical", "Database", "sql"),
        ("SQL Server", "Technical", "Database", "mssql"),
        ("C++", "Technical", "Language", "cpp"),
        ("CI/CD", "Technical", "Operations", "continuous integration"),
        ("Teamwork", "Soft", "People", None),
    ]
    return spark.createDataFrame(rows, "skill_name string, category string, subcategory string, aliases string")
