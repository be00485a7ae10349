import pytest

from tablevault import create_schema


def test_basic_types_and_nullability():
    schema = create_schema(
        [
            {"name": "a", "type": "string"},
            {"name": "b", "type": "integer", "nullable": False},
            {"name": "c", "type": "double"},
            {"name": "d", "type": "timestamp"},
            {"name": "e", "type": "boolean"},
        ]
    )
    assert schema.simpleString() == "struct<a:string,b:int,c:double,d:timestamp,e:boolean>"
    assert [f.nullable for f in schema] == [True, False, True, True, True]


@pytest.mark.parametrize(
    ("given", "made"),
    [
        ("BIGINT", "bigint"), ("TIMESTAMP", "timestamp"), ("Integer", "int"),
        ("decimal(10,2)", "decimal(10,2)"), ("array<int>", "array<int>"),
        ("map<string,int>", "map<string,int>"), ("nonsense", "string"),
    ],
)
def test_types_in_any_case(spark, given, made):
    assert create_schema([{"name": "x", "type": given}])["x"].dataType.simpleString() == made


def test_unknown_type_can_be_an_error(spark):
    with pytest.raises(ValueError, match="nonsense"):
        create_schema([{"name": "x", "type": "nonsense"}], on_unknown="error")
    with pytest.raises(ValueError):
        create_schema([], on_unknown="ignore")


@pytest.mark.parametrize("field", [{"name": "x"}, {"type": "string"}])
def test_name_and_type_are_required(field):
    with pytest.raises(KeyError):
        create_schema([field])
