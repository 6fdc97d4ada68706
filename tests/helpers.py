"""Small trip tables for tests."""

from datetime import date, datetime

from railtempo.schema import TRIPS

A, B = "Paris Nord", "Compiègne"


def at(day, clock):
    return datetime.fromisoformat(f"{day} {clock}") if clock else None


def trip(trip_id, day="2024-01-01", route="K01", headsign="01", start=A, end=B,
         departure="08:00:00", arrival="09:00:00", real_departure=None, real_arrival=None,
         departure_status=None, arrival_status=None, updated=None, **other):
    """One row of the trip table; clock texts are on the given day."""
    row = {
        "trip_id": trip_id,
        "route_id": f"route_{route}",
        "route_short_name": route,
        "trip_headsign": headsign,
        "departure_station_name": start,
        "departure_time_scheduled": at(day, departure),
        "siri_departure_time_real": at(day, real_departure),
        "siri_departure_status": departure_status,
        "arrival_station_name": end,
        "arrival_time_scheduled": at(day, arrival),
        "siri_arrival_time_real": at(day, real_arrival),
        "siri_arrival_status": arrival_status,
        "created_at": at(day, "00:00:00"),
        "siri_updated_at": updated,
        "service_date": date.fromisoformat(day),
        **other,
    }
    return tuple(row.get(name) for name in TRIPS.names)


def trips(spark, rows):
    return spark.createDataFrame(rows, TRIPS)


def by(df, *keys):
    """Collected rows by key."""
    rows = [r.asDict() for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
