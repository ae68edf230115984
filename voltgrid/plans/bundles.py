"""Bundles of lazy DataFrames replacing the reference's nested result
documents (B14, B18, R08, P07): one flat DataFrame per section. Nothing runs
until the caller acts on a section."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltgrid.operators import correlations, insights, patterns
from voltgrid.sources.tables import Tables


def network_insights(t: Tables) -> dict[str, DataFrame]:
    """Every section of the network insight document."""
    return {
        "network_overview": insights.network_overview(t.stations, t.usage, t.points),
        "stations_by_state": insights.stations_by(t.stations, "state"),
        "stations_by_city": insights.stations_by(t.stations, "city"),
        "stations_by_operator": insights.stations_by(t.stations, "operator"),
        "performance_metrics": insights.performance_metrics(t.stations, t.usage),
        "optimization_recommendations": insights.network_recommendations(t.stations, t.usage, t.points),
        "revenue_summary": insights.revenue_summary(t.usage),
        "top_revenue_stations": insights.top_revenue_stations(t.usage),
        "daily_revenue": insights.daily_revenue(t.usage),
        "revenue_trend": insights.revenue_trend(t.usage),
        "capacity_summary": insights.capacity_summary(t.points),
        "station_utilization": insights.station_utilization(t.points, t.usage),
    }


def station_insights(t: Tables, station_id: str | None = None) -> dict[str, DataFrame]:
    """Station info, usage statistics, capacity and recommendations for
    one station (filter pushed into every scan) or for all stations."""
    if station_id is not None:
        t = t.where_station(station_id)
    return {
        "station_info": t.stations,
        "usage_statistics": insights.station_usage_stats(t.usage),
        "capacity_info": insights.station_capacity(t.points),
        "recommendations": insights.station_recommendations(t.stations, t.usage, t.points),
        "summary": insights.station_insights(t.stations, t.usage, t.points),
    }


def correlation_report(t: Tables, by=()) -> dict[str, DataFrame]:
    """R08 in sections, plus the long-form table."""
    return {
        "weather_correlation": correlations.weather_usage_correlation(t.weather, t.usage, by),
        "weather_condition_impact": correlations.condition_impact(t.weather, t.usage, by),
        "traffic_correlation": correlations.traffic_usage_correlation(t.traffic, t.usage, by),
        "congestion_level_impact": correlations.congestion_impact(t.traffic, t.usage, by),
        "combined_correlation": correlations.combined_correlation(t.weather, t.traffic, t.usage, by),
        "insights": correlations.correlation_insights(t.weather, t.traffic, t.usage, by),
        "report": correlations.correlation_report(t.weather, t.traffic, t.usage, by),
    }


def usage_patterns(t: Tables, by=("station_id",)) -> dict[str, DataFrame]:
    """P01–P09 as one bundle (``by=[]`` for the network)."""
    return {
        "summary": patterns.usage_pattern_summary(t.usage, by),
        "peak_hours": patterns.peak_hours(t.usage, by),
        "day_of_week": patterns.weekday_weekend(t.usage, by),
        "usage_spikes": patterns.usage_spikes(t.usage, by),
        "low_usage_periods": patterns.low_usage_periods(t.usage, by),
        "session_duration": patterns.session_duration_stats(t.usage, by),
        "seasonal_trends": patterns.seasonal_trends(t.usage, by),
        "location_patterns_state": patterns.location_patterns(t.usage, t.stations, "state"),
        "location_patterns_city": patterns.location_patterns(t.usage, t.stations, "city"),
    }
