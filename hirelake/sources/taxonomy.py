"""Skill taxonomy seed: (category, standard_name, regex_pattern).

``regex_pattern`` is a PostgreSQL regular expression matched case-insensitively
against ``title || ' ' || description``.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TAXONOMY_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("standard_name", T.StringType(), False),
    T.StructField("regex_pattern", T.StringType(), False),
])

# The skill taxonomy seed of the warehouse (61 rows, in seed order).
# Skill names and patterns must equal the original seed for equal results.
TAXONOMY_CSV = r"""category,standard_name,regex_pattern
tech_stack,python,"\ypython\y|\ypython3\y|\ypandas\y"
tech_stack,java,"\yjava\y|\yjava 11\y|\yjava 17\y|\yjee\y"
tech_stack,c_sharp,"\yc#(?=\W|$)|\yc sharp\y|(?<!\w)\.net\y|\ydotnet\y"
tech_stack,javascript,"\yjavascript\y|\yjs\y|\yecmascript\y"
tech_stack,typescript,"\ytypescript\y"
tech_stack,go,"\ygolang\y|\ygo language\y|\ygo programming\y"
tech_stack,r,"\yr studio\y"
tech_stack,sql,"\ysql\y|\yt-sql\y|\ypl/sql\y"
tech_stack,postgresql,"\ypostgresql\y|\ypostgres\y|\ypsql\y"
tech_stack,mysql,"\ymysql\y|\ymariadb\y"
tech_stack,aws,"\yaws\y|\yamazon web services\y"
tech_stack,azure,"\yazure\y|\yms azure\y|\ymicrosoft azure\y"
tech_stack,gcp,"\ygcp\y|\ygoogle cloud\y|\ygcp platform\y"
tech_stack,kafka,"\ykafka\y|\yapache kafka\y"
tech_stack,flink,"\yflink\y|\yapache flink\y"
tech_stack,spark,"\yspark\y|\ypyspark\y|\yapache spark\y"
tech_stack,docker,"\ydocker\y|\ydockerfile\y"
tech_stack,kubernetes,"\ykubernetes\y|\yk8s\y"
tech_stack,terraform,"\yterraform\y"
tech_stack,ci_cd,"\yci/cd\y|\ycicd\y|\ycontinuous integration\y|\yjenkins\y|\ygithub actions\y|\ygitlab ci\y"
tech_stack,rest_api,"\yrestful\y|\yrest api\y|\yrest-api\y"
tech_stack,fastapi,"\yfastapi\y|\yfast-api\y"
tech_stack,springboot,"\yspring\y|\yspring boot\y|\yspring-boot\y"
tech_stack,react,"\yreact\y|\yreactjs\y|\yreact\.js\y"
tech_stack,excel,"\yexcel\y|\yms excel\y"
tech_stack,powerbi,"\ypowerbi\y|\ypower bi\y|\ypower-bi\y"
tech_stack,tableau,"\ytableau\y"
tech_stack,dbt,"\ydbt\y|\ydata build tool\y"
tech_stack,snowflake,"\ysnowflake\y"
tech_stack,databricks,"\ydatabricks\y"
tech_stack,airflow,"\yairflow\y|\yapache airflow\y"
tech_stack,git,"\ygit\y|\ygithub\y|\ygitlab\y|\ybitbucket\y"
tech_stack,linux,"\ylinux\y|\yubuntu\y|\ydebian\y|\ybash\y"
tech_stack,mongodb,"\ymongodb\y|\ymongo\y"
tech_stack,redis,"\yredis\y"
tech_stack,elasticsearch,"\yelasticsearch\y|\yelastic search\y|\ykibana\y"
tech_stack,kotlin,"\ykotlin\y"
tech_stack,angular,"\yangular\y|\yangularjs\y"
tech_stack,vue,"\yvuejs\y|\yvue\.js\y|\yvue\y"
tech_stack,microservices,"\ymicroservices\y|\ymicroservice\y"
tech_stack,graphql,"\ygraphql\y"
tech_stack,hadoop,"\yhadoop\y"
tech_stack,hive,"\yhive\y|\yapache hive\y"
tech_stack,sap,"\ysap\y|\ysap bw\y|\ysap hana\y|\ys/4hana\y"
tech_stack,node_js,"\ynode\.?js\y|\ynode\y"
tech_stack,html_css,"\yhtml\y|\ycss\y|\yhtml5\y|\ycss3\y"
tech_stack,c_plus_plus,"\yc\+\+\y"
tech_stack,ruby,"\yruby\y|\yruby on rails\y|\yrails\y"
tech_stack,php,"\yphp\y"
tech_stack,scala,"\yscala\y"
tech_stack,rust,"\yrust\y"
tech_stack,pytorch,"\ypytorch\y"
tech_stack,tensorflow,"\ytensorflow\y|\ytf\y"
tech_stack,scikit_learn,"\yscikit[- ]learn\y|\ysklearn\y"
tech_stack,looker,"\ylooker\y"
tech_stack,qlik,"\yqlik\y|\yqlikview\y|\yqlik sense\y"
tech_stack,bigquery,"\ybigquery\y|\ybq\y"
tech_stack,redshift,"\yredshift\y"
tech_stack,ansible,"\yansible\y"
tech_stack,machine_learning,"\ymachine learning\y|\yml\y|\ydeep learning\y|\ynlp\y"
tech_stack,artificial_intelligence,"\yartificial intelligence\y|\yai\y|\ygenerative ai\y|\yllm\y|\yopenai\y"
"""


def taxonomy_rows() -> list[tuple[str, str, str]]:
    reader = csv.reader(io.StringIO(TAXONOMY_CSV.strip("\n")))
    next(reader)
    return [tuple(r) for r in reader if r]


def write_seed(spark: SparkSession, path: str) -> str:
    """Write the seed as a CSV folder (as a warehouse seed folder would hold it)."""
    (spark.createDataFrame(taxonomy_rows(), TAXONOMY_SCHEMA).coalesce(1).write.mode("overwrite")
     .option("header", True).option("quoteAll", True).option("escape", '"').csv(path))
    return path


def read_taxonomy(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Seed scan: with ``path`` a CSV file with a header and quoted regexes,
    otherwise the built-in seed."""
    if path is not None:
        return (spark.read.schema(TAXONOMY_SCHEMA).option("header", True)
                .option("escape", '"').option("mode", "FAILFAST").csv(path))
    return spark.createDataFrame(taxonomy_rows(), TAXONOMY_SCHEMA)
