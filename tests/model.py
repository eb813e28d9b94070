"""The sync as loops over rows held in lists of dicts: slow, plain, and separate
from the library. Used on tiny catalogues only."""

from __future__ import annotations

import copy
from datetime import datetime, timedelta

from tidemark.schemas import TARGETS


class SeveralRows(Exception):
    pass


class Model:
    def __init__(self, src, tgt, code, services, agency, as_of, offset=-1, regional=True):
        self.src = src
        self.tgt = {k: copy.deepcopy(v) for k, v in tgt.items()}
        self.code, self.services, self.agency = code, services, agency
        self.now, self.regional = as_of, regional
        day = as_of + timedelta(days=offset)
        self.cut = datetime(day.year, day.month, day.day)

    # helpers

    def new(self, row, *cols):
        return any(row[c] is not None and row[c] > self.cut for c in cols or ("crt_dt", "upd_dt"))

    def here(self, table):
        return [r for r in self.src[table] if r["nation_cd"] == self.code]

    def has(self, rows, **key):
        return any(all(v is not None and r[k] == v for k, v in key.items()) for r in rows)

    @staticmethod
    def ok(*codes, approved="Y"):
        return "OK" if all(c == "A" for c in codes) and approved == "Y" else "BLIND"

    @staticmethod
    def only(values):
        if len(values) > 1:
            raise SeveralRows
        return values[0] if values else None

    def merge(self, table, deltas, keys, match, insert):
        target = self.tgt[table]
        hits = []
        for d in deltas:
            found = [t for t in target if all(d[k] is not None and t[k] == d[k] for k in keys)]
            hits.append(found)
        seen = set()
        for found in hits:
            for t in found:
                if id(t) in seen:
                    raise SeveralRows
                seen.add(id(t))
        for d, found in zip(deltas, hits, strict=True):
            for t in found:
                t.update(match(d))
            if not found:
                row = dict.fromkeys(TARGETS[table].names)
                row.update({k: d[k] for k in keys})
                row.update(insert(d))
                target.append(row)

    # steps

    def genre(self):
        roots = [r for r in self.src["tmu_genre"] if r["genre_cd"] == r["pgenre_cd"] and r["genre_cd"] is not None]
        deltas = [{"genre_id": r["genre_cd"], "nm": r["genre_nm"]} for r in roots]
        self.merge(
            "genre", deltas, ["genre_id"], lambda d: {"genre_nm": d["nm"]},
            lambda d: {"genre_nm": d["nm"], "crt_dt": self.now},
        )

    def style(self):
        deltas = [
            {"style_id": r["pgenre_cd"], "genre": r["genre_cd"], "nm": r["genre_nm"]}
            for r in self.src["tmu_genre"]
            if None not in (r["genre_cd"], r["pgenre_cd"])
            and r["genre_cd"] != r["pgenre_cd"]
            and self.has(self.tgt["genre"], genre_id=r["genre_cd"])
        ]
        self.merge(
            "style", deltas, ["style_id"], lambda d: {"style_nm": d["nm"]},
            lambda d: {"genre_id": d["genre"], "style_nm": d["nm"], "crt_dt": self.now},
        )

    def pairs(self, base, region, key):
        return [(b, w) for b in self.src[base] for w in self.here(region) if b[key] == w[key]]

    def artist(self):
        picked = []
        if self.regional:
            for b, w in self.pairs("ted_artist", "ted_artist_w", "artist_id"):
                if self.new(b) or self.new(w):
                    picked.append((b, self.ok(w["db_sts"], b["db_sts"])))
        else:
            ids = {w["artist_id"] for w in self.here("ted_artist_w") if self.new(w)}
            picked = [(b, self.ok(b["db_sts"])) for b in self.src["ted_artist"] if b["artist_id"] in ids]
        deltas = []
        for b, status in picked:
            site = self.only([
                s["site_url"] for s in self.src["tfm_website"]
                if s["rel_entity_cd"] == "ted_artist" and s["rel_id"] == b["artist_id"]
            ])
            kept = {k: v for k, v in b.items() if k not in ("upd_dt", "db_sts")}
            deltas.append(kept | {"homepage_url": site, "status": status})
        self.merge("artist", deltas, ["artist_id"], lambda d: d | {"upd_dt": self.now}, lambda d: d)

    def artist_local(self):
        deltas = [
            w | {"local_cd": self.code} for w in self.here("ted_artist_w")
            if self.new(w) and (not self.regional or self.has(self.tgt["artist"], artist_id=w["artist_id"]))
        ]

        def values(d):
            return {"disp_nm_local": d["artist_nm"], "search_nm_local": d["artist_nm"], "status": self.ok(d["db_sts"])}

        self.merge(
            "artist_local", deltas, ["artist_id", "local_cd"], lambda d: values(d) | {"upd_dt": self.now},
            lambda d: values(d) | {"crt_dt": d["crt_dt"]},
        )

    def fresh_styles(self, table, region, key, parent):
        if self.regional:
            return [
                s for s in self.src[table]
                if self.new(s, "crt_dt") and self.has(self.tgt["style"], style_id=s["style_id"])
                and (parent is None or self.has(self.tgt[parent], **{key: s[key]}))
            ]
        ids = {
            s[key] for s in self.src[table] if self.new(s, "crt_dt") and self.has(self.here(region), **{key: s[key]})
        }
        return [s for s in self.src[table] if s[key] in ids]

    def artist_style(self):
        self.merge(
            "artist_style", self.fresh_styles("tbm_artiststyle", "ted_artist_w", "artist_id", "artist"),
            ["artist_id", "style_id"], lambda d: {"listorder": d["listorder"]},
            lambda d: {"listorder": d["listorder"], "crt_dt": self.now},
        )

    def first_artist(self, links, key, value):
        living = [
            a["artist_id"] for a in self.src[links]
            if a[key] == value and a["rp_cd"] == "Y" and a["db_sts"] == "A"
            and self.has(self.tgt["artist"], artist_id=a["artist_id"])
        ]
        return min(living, default=None)

    def loop_ids(self, region, links, key, base=None):
        """Ids of a cursor over region rows joined with their links."""
        ids = []
        for w in self.here(region):
            for a in self.src[links]:
                changed = self.new(w) or self.new(a, "upd_dt")
                if base is not None:
                    changed = changed or any(b[key] == w[key] and self.new(b) for b in self.src[base])
                if a[key] is not None and a[key] == w[key] and changed and w[key] not in ids:
                    ids.append(w[key])
        return ids

    def album_rows(self, b, status):
        artist = self.first_artist("ted_albumartist", "album_id", b["album_id"])
        return {
            "album_id": b["album_id"], "title": b["title"], "search_title": b["search_title"], "artist_id": artist,
            "nation_cd": b["nation_cd"], "release_ymd": b["release_ymd"], "keyword": b["search_title"],
            "album_tp": b["album_type"], "status": status, "agency_id": self.agency, "_crt": b["crt_dt"],
        }

    def merge_albums(self, deltas):
        def plain(d):
            return {k: v for k, v in d.items() if k != "_crt"}

        self.merge(
            "album", deltas, ["album_id"], lambda d: plain(d) | {"upd_dt": self.now},
            lambda d: plain(d) | {"crt_dt": d["_crt"]},
        )

    def merge_album_local(self, picked):
        def values(d):
            return {"title_local": d["title"], "search_title_local": d["title"], "status": self.ok(d["db_sts"])}

        self.merge(
            "album_local", [w | {"local_cd": self.code} for w in picked], ["album_id", "local_cd"],
            lambda d: values(d) | {"upd_dt": self.now}, lambda d: values(d) | {"crt_dt": d["crt_dt"]},
        )

    def albums(self):
        links = self.src["ted_albumartist"]
        if not self.regional:
            for album_id in self.loop_ids("ted_album_w", "ted_albumartist", "album_id"):
                base = [b for b in self.src["ted_album"] if b["album_id"] == album_id]
                self.merge_albums([self.album_rows(b, self.ok(b["db_sts"])) for b in base])
                self.merge_album_local([w for w in self.here("ted_album_w") if w["album_id"] == album_id])
            return
        picked = [
            self.album_rows(b, self.ok(b["db_sts"], w["db_sts"], approved=b["svc_aprv_yn"]))
            for b, w in self.pairs("ted_album", "ted_album_w", "album_id")
            if self.new(b) or self.new(w) or any(a["album_id"] == b["album_id"] and self.new(a) for a in links)
        ]
        self.merge_albums(picked)
        self.merge_album_local([
            w for w in self.here("ted_album_w")
            if (self.new(w) or any(a["album_id"] == w["album_id"] and self.new(a, "upd_dt") for a in links))
            and self.has(self.tgt["album"], album_id=w["album_id"])
        ])

    def right(self, track_id, kind):
        found = [
            r["right_yn"] for r in self.src["ttmp_trackright"]
            if r["track_id"] == track_id and r["service_id"] == self.services[kind]
        ]
        return self.only(found) or "N"

    def tracks(self):
        base = "ted_track" if self.regional else None
        for track_id in self.loop_ids("ted_track_w", "ted_trackartist", "track_id", base):
            self.one_track(track_id)

    def one_track(self, track_id):
        region = [w for w in self.here("ted_track_w") if w["track_id"] == track_id]
        deltas = []
        for b in self.src["ted_track"]:
            if b["track_id"] != track_id:
                continue
            row = {k: v for k, v in b.items() if k not in ("upd_dt", "db_sts", "svc_mmp3_yn")}
            row |= {k: v or "N" for k, v in row.items() if k.endswith("_yn")}
            row |= {
                "svc_wma_yn": b["svc_mmp3_yn"] or "N",
                "artist_id": self.first_artist("ted_trackartist", "track_id", track_id),
            }
            if not self.regional:
                deltas.append(row | {"status": self.ok(b["db_sts"])})
            elif self.has(self.tgt["album"], album_id=b["album_id"]):
                deltas += [row | {"status": self.ok(b["db_sts"], w["db_sts"])} for w in region]
        self.merge("track", deltas, ["track_id"], lambda d: d | {"upd_dt": self.now}, lambda d: d)

        if self.regional and not self.has(self.tgt["track"], track_id=track_id):
            region = []
        deltas = []
        for w in region:
            values = {"track_title_local": w["track_title"], "status": self.ok(w["db_sts"])}
            for kind in self.services:
                values[f"{kind}_rights_yn"] = self.right(track_id, kind)
            if "rent" in self.services:
                values |= {c: w[c] for c in ("track_title_alt", "search_title")}
            values["mv_str_rights_yn"] = values["str_rights_yn"]
            deltas.append({"track_id": track_id, "local_cd": self.code, "_crt": w["crt_dt"], "_values": values})
        kept = set()
        if not self.regional:
            kept = {"status"}
        elif "rent" not in self.services:
            kept = {"mv_str_rights_yn"}
        self.merge(
            "track_local", deltas, ["track_id", "local_cd"],
            lambda d: {k: v for k, v in d["_values"].items() if k not in kept} | {"upd_dt": self.now},
            lambda d: d["_values"] | {"crt_dt": d["_crt"]},
        )
        for t in self.tgt["track_local"]:
            if t["track_id"] == track_id:
                key = {"track_id": track_id, "local_cd": t["local_cd"]}
                if self.has(self.src["time_lyrics"], **key):
                    t["lyrics_tp"] = "T"
                if self.has(self.src["normal_lyrics"], **key) and t["lyrics_tp"] != "T":
                    t["lyrics_tp"] = "N"

    def album_and_track_styles(self):
        listed = self.fresh_styles("tbm_albumstyle", "ted_album_w", "album_id", "album")
        self.merge(
            "album_style", listed, ["album_id", "style_id"], lambda d: {"listorder": d["listorder"]},
            lambda d: {"listorder": d["listorder"], "crt_dt": d["crt_dt"]},
        )
        deltas = [
            s | {"track_id": t["track_id"]}
            for s in self.fresh_styles("tbm_albumstyle", "ted_album_w", "album_id", None)
            for t in self.tgt["track"] if t["album_id"] == s["album_id"] and t["album_id"] is not None
        ]
        self.merge(
            "track_style", deltas, ["track_id", "style_id"], lambda d: {"listorder": d["listorder"]},
            lambda d: {"listorder": d["listorder"], "crt_dt": d["crt_dt"]},
        )

    def mv_rows(self, b, status, updated):
        links = [
            a for a in self.src["ted_mvtrack"]
            if a["mv_id"] == b["mv_id"] and (not self.regional or a["db_sts"] == "A")
        ]
        if not links:
            return []
        first = min(links, key=lambda a: (a["mvtrack_id"], a["track_id"]))
        out = []
        for t in self.tgt["track"]:
            if t["track_id"] == first["track_id"]:
                row = {k: v for k, v in b.items() if k in TARGETS["mv"].names}
                row |= {
                    "track_id": t["track_id"], "artist_id": t["artist_id"], "highrate_yn": b["high_yn"],
                    "status": status, "upd_dt": updated,
                }
                out.append(row)
        return out

    def merge_mv(self, deltas):
        self.merge("mv", deltas, ["mv_id"], lambda d: d | {"upd_dt": self.now}, lambda d: d)

    def merge_mv_local(self, picked):
        def values(d):
            return {"mv_title_local": d["mv_title"], "status": self.ok(d["db_sts"])}

        known = [w | {"local_cd": self.code} for w in picked if self.has(self.tgt["mv"], mv_id=w["mv_id"])]
        self.merge(
            "mv_local", known, ["mv_id", "local_cd"], lambda d: values(d) | {"upd_dt": self.now},
            lambda d: values(d) | {"crt_dt": d["crt_dt"]},
        )

    def videos(self):
        if not self.regional:
            ids = self.loop_ids("ted_mv_w", "ted_mvtrack", "mv_id")
            for mv_id in ids:
                for b in [b for b in self.src["ted_mv"] if b["mv_id"] == mv_id]:
                    self.merge_mv(self.mv_rows(b, self.ok(b["db_sts"]), b["upd_dt"]))
                self.merge_mv_local([w for w in self.here("ted_mv_w") if w["mv_id"] == mv_id])
            self.merge_mv_local([w for w in self.here("ted_mv_w") if w["mv_id"] in ids])
            return
        for t in self.tgt["mv"]:
            for a in self.src["ted_mvtrack"]:
                gone = a["db_sts"] == "D" and self.new(a, "upd_dt")
                if gone and a["mv_id"] == t["mv_id"] and a["track_id"] == t["track_id"]:
                    t.update(status="BLIND", upd_dt=self.now)
        links = self.src["ted_mvtrack"]
        deltas = []
        for b, w in self.pairs("ted_mv", "ted_mv_w", "mv_id"):
            if self.new(b) or self.new(w) or any(a["mv_id"] == b["mv_id"] and self.new(a, "upd_dt") for a in links):
                status = self.ok(b["db_sts"], w["db_sts"], approved=b["svc_aprv_yn"])
                deltas += self.mv_rows(b, status, w["upd_dt"])
        self.merge_mv(deltas)
        self.merge_mv_local([w for w in self.here("ted_mv_w") if self.new(w)])

    def album_status(self):
        for t in self.tgt["album_local"]:
            if t["local_cd"] != self.code:
                continue
            held = any(
                r["album_id"] == t["album_id"] and r["right_yn"] == "Y" and r["service_id"] in self.services.values()
                for r in self.src["ttmp_trackright"]
            )
            if not held:
                t.update(status="BLIND", upd_dt=self.now)
            elif t["status"] is not None and t["status"] != "OK":
                t.update(status="OK", upd_dt=self.now)

    def catalog(self):
        if self.regional:
            self.genre()
            self.style()
        self.artist()
        self.artist_local()
        self.artist_style()
        self.albums()
        self.tracks()
        self.album_and_track_styles()
        self.videos()
        if self.regional:
            self.album_status()
        return self.tgt

    def rights(self):
        columns = {"str": ["str_rights_yn", "mv_str_rights_yn"], "dnl": ["dnl_rights_yn"], "rent": ["rent_rights_yn"]}
        for kind, service in self.services.items():
            for t in self.tgt["track_local"]:
                if t["local_cd"] != self.code:
                    continue
                found = [
                    r for r in self.src["ttmp_trackright"]
                    if r["track_id"] == t["track_id"] and r["service_id"] == service and self.new(r)
                ]
                if found:
                    value = self.only(found)["right_yn"] or "N"
                    t.update({c: value for c in columns[kind]} | {"upd_dt": self.now})
        self.album_status()
        return self.tgt
