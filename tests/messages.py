"""Message builders shared by the tests."""

import json

SINGLE = {
    "api_version": "websocket/v1",
    "kind": "News/v1",
    "data": {
        "action": "Created",
        "id": 4711,
        "timestamp": "2031-05-06T07:08:09Z",
        "content": {
            "id": 99,
            "revision_id": 1,
            "type": "story",
            "title": "Lighthouse Bakery opens a second mill",
            "body": "<p>Bakers said on Monday that the mill <b>doubled</b> the flour they can grind.</p>",
            "authors": ["Ida Quill", "Tom Reed"],
            "teaser": "<p>More flour from the coast</p>",
            "url": "https://news.invalid/mill",
            "channels": ["Food", "Regional"],
            "securities": [{"symbol": "LHBK", "exchange": "COAST", "primary": True}],
            "created_at": "2031-05-06T06:55:00Z",
            "updated_at": "2031-05-06T07:00:00Z",
        },
    },
}


def message(data=None, **content):
    """The single-ticker message as JSON text with some fields replaced; DROP removes one."""
    msg = json.loads(json.dumps(SINGLE))
    for target, changes in ((msg["data"], data or {}), (msg["data"]["content"], content)):
        for name, value in changes.items():
            if value is DROP:
                target.pop(name)
            else:
                target[name] = value
    return json.dumps(msg)


DROP = object()


def frame(spark, *raws):
    return spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "key int, raw string").coalesce(1)
