"""Invented match documents for the golden cases."""

from __future__ import annotations

import copy
import json

PEOPLE = {f"{x} One": f"p{i:02d}" for i, x in enumerate("ABCDEFGH", 1)}


def ball(batter="A One", bowler="E One", partner="B One", runs=0, extras=None, wickets=None, **more):
    extra = sum((extras or {}).values())
    d = {"batter": batter, "bowler": bowler, "non_striker": partner,
         "runs": {"batter": runs, "extras": extra, "total": runs + extra}}
    if extras:
        d["extras"] = extras
    if wickets:
        d["wickets"] = wickets
    return {**d, **more}


def out(who="A One", kind="bowled", fielders=()):
    w = {"player_out": who, "kind": kind}
    if fielders:
        w["fielders"] = [{"name": f} for f in fielders]
    return w


FIRST = {
    "info": {
        "teams": ["Reds ", "Blues"], "season": "2007/08", "dates": ["2008-04-18"], "venue": " Oval", "city": "Town",
        "toss": {"winner": "Reds", "decision": "field"},
        "outcome": {"winner": "Blues", "by": {"wickets": 4, "runs": 10}},
        "event": {"name": "Cup", "match_number": 1}, "match_type": "T20", "overs": 20, "balls_per_over": 6,
        "players": {"Reds": ["A One", "B One", "C One"], "Blues": ["E One", "F One", "A One"], "Greens": ["D One"]},
        "player_of_match": ["A One"], "officials": {"umpires": ["G One", "H One"], "referee": "G One"},
        "registry": {"people": dict(PEOPLE)},
    },
    "innings": [
        {
            "team": "Reds", "target": {"runs": 9, "overs": 20}, "powerplays": [{"type": "mandatory", "from": 0.1, "to": 5.6}],
            "overs": [
                {"over": 0, "deliveries": [
                    ball(runs=4), ball(extras={"wides": 1}), ball(runs=6, review={"by": "Blues", "odd": [1, {"k": 2}]}),
                    ball(wickets=[out(kind="caught", fielders=["F One", "F One"])]),
                    ball("C One", wickets=[out("C One")]), ball("C One", wickets=[out("C One", "lbw")]),
                    ball("C One", runs=1, wickets=[out("C One", "run out"), out("B One", "retired out")])]},
                {"over": 1, "deliveries": [ball(runs=2, bowler="F One", replacements={
                    "match": [{"team": "Reds", "in": "D One", "out": "A One", "reason": "sub"}],
                    "role": [{"role": "bowler", "in": "F One", "reason": "injury"}]})]},
            ],
        },
        {"team": "Blues", "target": {"runs": 15, "overs": 20}, "overs": [{"over": 0, "deliveries": [
            ball("E One", "A One", "F One", 6), ball("E One", "A One", "F One", 6), ball("E One", "A One", "F One", 3)]}]},
        {"team": "Reds", "super_over": True, "overs": [{"over": 0, "deliveries": [ball(runs=6), ball(runs=6)]}]},
    ],
}


def variant_of(doc, **info):
    new = copy.deepcopy(doc)
    new["info"].update(info)
    return new


SECOND = variant_of(FIRST, season=2023, outcome={"result": "tie"}, city="Else", dates=["2023-05-01"])
BY_DATE = variant_of(FIRST, season="abc", outcome={}, dates=["2019-01-02"], venue="Park", city=None)
NO_SEASON = variant_of(FIRST, season=None, dates=[])
UNKNOWN_NAME = variant_of(FIRST, registry={"people": {k: v for k, v in PEOPLE.items() if k != "B One"}})
STRANGER = variant_of(FIRST, registry={"people": {**PEOPLE, "C One": "nobody"}})

ALL = {"m1": FIRST, "m2": SECOND, "m3": BY_DATE, "m4": NO_SEASON, "m5": UNKNOWN_NAME, "m6": STRANGER}


def staged(spark, docs=None):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in (docs or ALL).items()], "id string, document string")


def people(spark):
    data = [(i, n, n, f"k{i}") for n, i in PEOPLE.items()]
    return spark.createDataFrame(data, "identifier string, name string, unique_name string, key_cricinfo string")
