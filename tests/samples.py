"""Review records the tests share."""

BASE = {
    "review_id": "rev-0001",
    "product_id": "prod-204",
    "product_name": "Tin Kettle",
    "source_language": "en",
    "rating": 5,
    "title": "Boils fast",
    "body": "Light, and the lid stays on.",
}


def review(**changes):
    return {**BASE, **changes}
