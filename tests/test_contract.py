from tarmac.contract import FLIGHTS


def test_vector_slots_are_pinned():
    assert FLIGHTS.features == [
        "MONTH", "DISTANCE_GROUP", "PLANE_AGE", "PRCP", "SNOW", "AWND",
        "DepBlockIndex", "CarrierNameIndex", "DepartingAirportIndex", "PreviousAirportIndex",
    ]


def test_line_columns_cover_every_position():
    names = FLIGHTS.line_columns
    assert len(names) == len(set(names)) == 26
    assert [names[f.position] for f in FLIGHTS.fields] == FLIGHTS.columns
    assert names[1] == "_c1"


def test_typed_schema():
    assert FLIGHTS.typed_schema.simpleString() == (
        "struct<MONTH:int,DEP_DEL15:double,DISTANCE_GROUP:double,DEP_BLOCK:string,CARRIER_NAME:string,"
        "PLANE_AGE:int,DEPARTING_AIRPORT:string,PREVIOUS_AIRPORT:string,PRCP:double,SNOW:double,AWND:double>"
    )


def test_inputs_leave_out_the_label():
    assert FLIGHTS.label not in FLIGHTS.inputs and len(FLIGHTS.inputs) == 10
