import json

from kuramori.operators.nested import classify, risk_scenarios, subtype_tables

RAW = "raw_id long, source_gml string, city_code string, payload string, received_at timestamp, building_gml_id string"


def raw(spark, payloads):
    return spark.createDataFrame([(i, "s.gml", "13901", p, None, "clash") for i, p in enumerate(payloads, 1)], RAW)


def found(spark, payloads):
    return sorted(tuple(r) for r in risk_scenarios(raw(spark, payloads)).collect())


def test_layouts_give_the_same_rows(spark):
    body = {"rank": {"code": "2"}, "scenarios": [None, {"scale": 1}, {"scale": "2"}]}
    layouts = [
        {"CityModel": {"cityObjectMember": [{"Building": {"@gml:id": "b", "bldgDisasterRiskAttribute": {"TsunamiRiskAttribute": [None, body]}}}]}},
        {"Building": {"gml:id": "b", "uro:bldgDisasterRiskAttribute": [None, {"uro:TsunamiRiskAttribute": body}]}},
        {"gml_id": "b", "bldgDisasterRiskAttribute": {"type": "uro:TsunamiRiskAttribute", **body}},
        {"gml_id": "b", "bldgDisasterRiskAttribute": [{"type": "TsunamiRiskAttribute", "rank": 2, "scenarios": [{"scale": 1}, {"scale": 2}]}]},
    ]
    expected = [("b", 1, 1, "TsunamiRiskAttribute", "2"), ("b", 1, 2, "TsunamiRiskAttribute", "2")]
    for layout in layouts:
        assert found(spark, [json.dumps(layout)]) == expected


def test_parts_hold_their_own_risks(spark):
    p = {"gml_id": "b", "consistsOfBuildingPart": {"BuildingPart": {"gml:id": "b_p1", "bldgDisasterRiskAttribute": {"LandSlideRiskAttribute": {"rank": None, "scenarios": {"scale": 1}}}}}}
    assert found(spark, [json.dumps(p)]) == [("b_p1", 1, 1, "LandSlideRiskAttribute", "")]
    parts = subtype_tables(raw(spark, [json.dumps(p)]))["parts"].collect()
    assert [(r.node_key, r.parent_key) for r in parts] == [("b_p1", "b")]


def test_bad_payloads_and_redelivery(spark):
    good = json.dumps({"gml_id": "b", "bldgDisasterRiskAttribute": [{"type": "FireSpreadRiskAttribute", "rank": "1"}]})
    assert found(spark, [None, "", "[]", "{}", '"text"', "{\"gml_id\": \"x\"", good, good]) == [("b", 1, 0, "FireSpreadRiskAttribute", "1")]
    assert found(spark, []) == []


def test_encoded_strings_at_both_levels(spark):
    inner = {"TsunamiRiskAttribute": {"rank": {"code": "2"}, "scenarios": json.dumps([{"scale": 1}, None])}}
    building = {"gml_id": "b", "bldgDisasterRiskAttribute": json.dumps(inner)}
    expected = [("b", 1, 1, "TsunamiRiskAttribute", "2")]
    assert found(spark, [json.dumps(building)]) == expected
    assert found(spark, [json.dumps(json.dumps(building))]) == expected
    assert found(spark, [json.dumps(json.dumps(json.dumps({"Building": json.dumps(building)})))]) == expected
    assert found(spark, [json.dumps(json.dumps(building)[:-1]), json.dumps(json.dumps(building))[:-1], '"[1, 2]"', '"\\"\\""']) == []


def test_units_and_codes(spark):
    body = {"depth": {"#text": "250", "@uom": "cm"}, "duration": {"value": 30, "uom": "min"}, "adminType": {"#text": "3", "@codeSpace": "x/y.xml"}}
    r = subtype_tables(raw(spark, [json.dumps({"gml_id": "b", "bldgDisasterRiskAttribute": {"HighTideRiskAttribute": body}})]))["risks"].first()
    assert (r.depth_value, r.depth_uom, r.depth_m, r.duration_h, r.admin_type_code, r.admin_type_codespace) == (250.0, "cm", 2.5, 0.5, "3", "x/y.xml")


def test_every_unit_name_is_known(spark):
    body = lambda d, h: {"depth": {"value": 250, "uom": d}, "duration": {"value": 30, "uom": h}}
    units = [("centimetre", "minutes"), ("metres", "hours"), ("furlong", "moon")]
    payloads = [json.dumps({"gml_id": f"b{i}", "bldgDisasterRiskAttribute": {"HighTideRiskAttribute": body(*u)}}) for i, u in enumerate(units)]
    got = {r.building_gml_id: (r.depth_m, r.duration_h) for r in subtype_tables(raw(spark, payloads))["risks"].collect()}
    assert got == {"b0": (2.5, 0.5), "b1": (250.0, 30.0), "b2": (None, None)}


def test_states():
    assert classify({"code": "1"}, "rank").state == "code.pair"
    assert classify({"value": 1, "uom": "m"}, "depth").state == "measure"
    assert classify({"type": "T"}, "bldgDisasterRiskAttribute").state == "risk.flat"
    assert classify({"CityModel": {}}).state == "wrapper"
